"""Word lists, formats and limits that decide results. Do not reorder."""

# --- text triage: category, confidence, reason, phrases (first category that matches wins)
INJECTION_PHRASES = [
    "ignore previous instructions",
    "disregard all previous",
    "system override",
    "override all",
    "system:",
    "<system>",
    "maintenance mode",
    "grant full access",
    "bypass",
    "jailbreak",
    "you are now",
    "as an administrator",
    "sudo grant",
    "prompt leakage",
]
EXFILTRATION_PHRASES = ["exfiltration", "dump database", "leak", "export all credit cards"]
AUDIT_PHRASES = ["audit", "compliance", "regulatory", "sox", "finma"]
INCIDENT_PHRASES = ["incident", "outage", "p1", "sev-1", "emergency triage"]
UNJUSTIFIED_PHRASES = ["test", "asdf", "please give access"]
TRIAGE_MIN_CHARS = 10
TRIAGE_MAX_CHARS = 500

TRIAGE_REASONS = {
    "injection": "Adversarial prompt injection pattern detected",
    "exfiltration": "Suspicious data exfiltration intent detected",
    "audit": "Classified as legitimate compliance audit",
    "incident": "Classified as urgent incident triage",
    "unjustified": "Insufficient justification provided",
    "other": "Standard request - human review required",
    "limited": "Rate limit exceeded - routed to manual review",
}

# --- token bucket per caller
BUCKET_TOKENS = 20
BUCKET_SECONDS = 60

# --- masks
REDACTED = "[REDACTED]"
REDACTED_ART9 = "[REDACTED-GDPR-ART9]"

# --- schema type names
EDM_TYPES = {
    "int": "Edm.Int32",
    "integer": "Edm.Int32",
    "int4": "Edm.Int32",
    "serial": "Edm.Int32",
    "bigint": "Edm.Int64",
    "int8": "Edm.Int64",
    "bigserial": "Edm.Int64",
    "smallint": "Edm.Int16",
    "int2": "Edm.Int16",
    "decimal": "Edm.Decimal",
    "numeric": "Edm.Decimal",
    "money": "Edm.Decimal",
    "float": "Edm.Single",
    "real": "Edm.Single",
    "float4": "Edm.Single",
    "double": "Edm.Double",
    "float8": "Edm.Double",
    "double precision": "Edm.Double",
    "bool": "Edm.Boolean",
    "boolean": "Edm.Boolean",
    "bit": "Edm.Boolean",
    "date": "Edm.Date",
    "timestamp": "Edm.DateTimeOffset",
    "timestamptz": "Edm.DateTimeOffset",
    "datetime": "Edm.DateTimeOffset",
    "datetime2": "Edm.DateTimeOffset",
    "datetimeoffset": "Edm.DateTimeOffset",
    "guid": "Edm.Guid",
    "uuid": "Edm.Guid",
}
EDM_DEFAULT = "Edm.String"

CONTRACT_TYPES = {
    "int": "integer",
    "integer": "integer",
    "int4": "integer",
    "bigint": "bigint",
    "int8": "bigint",
    "varchar": "string",
    "text": "string",
    "string": "string",
    "nvarchar": "string",
    "char": "string",
    "bool": "boolean",
    "boolean": "boolean",
    "float": "decimal",
    "double": "decimal",
    "real": "decimal",
    "numeric": "decimal",
    "decimal": "decimal",
    "timestamp": "timestamp",
    "timestamptz": "timestamp",
    "datetime": "timestamp",
    "datetime2": "timestamp",
}

# --- file locations
RESTRICTED_ROOTS = [
    "/etc",
    "/proc",
    "/sys",
    "/dev",
    "/var",
    "/run",
    "/root",
    "/bin",
    "/sbin",
    "/usr",
]
RESTRICTED_PARTS = ["/.ssh/", "windows/system32"]
MAX_OBJECT_BYTES = 64 * 1024 * 1024
MAX_PAYLOAD_BYTES = 10 * 1024 * 1024

# --- scan and paging limits
SCAN_DEFAULT_LIMIT = 1000
SCAN_MAX_LIMIT = 50_000
PAGE_DEFAULT = 100
PAGE_MAX = 1000
FEED_BATCH_DEFAULT = 500
FEED_BATCH_MAX = 5000
PULL_MAX_PAGES = 1000

# --- events
EVENT_TOLERANCE_SECONDS = 300
EVENT_DEDUPE_SECONDS = 900
EPOCH_MILLIS_ABOVE = 10_000_000_000
EVENT_ID_FIELDS = ["id", "eventId", "event_id", "changeEventId"]

# --- ticket payload fields, in order of preference
TICKET_EVENT_FIELDS = ["EventId", "eventId", "event_id", "DeliveryId", "deliveryId", "delivery_id"]
TICKET_APPROVER_FIELDS = [
    "Approver",
    "approver",
    "ApprovedBy",
    "approvedBy",
    "approved_by",
    "sys_updated_by",
]
TICKET_USER_FIELDS = ["accountId", "name", "emailAddress", "displayName"]
PENDING_REQUEST = "PENDING_EXTERNAL_APPROVAL"

# --- access grants
AUTO_GRANTABLE = ["NORMAL", "LOW", "PUBLIC", "INTERNAL"]
HIGH_SENSITIVITY = ["HIGH", "RESTRICTED"]
ALLOW_OPERATIONS = ["ViewAll", "ViewSampleData"]
DENY_OPERATIONS = ["ViewAll", "ViewSampleData", "All"]
DENY_VALID_DAYS = 365
DENY_REFRESH_DAYS = 30
GRANT_BACKDATE_MINUTES = 5

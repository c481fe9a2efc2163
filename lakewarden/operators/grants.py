"""Access grants derived from policies, and their reconciliation with the grants held."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakewarden.fixed_values import (
    ALLOW_OPERATIONS,
    AUTO_GRANTABLE,
    DENY_OPERATIONS,
    DENY_REFRESH_DAYS,
    DENY_VALID_DAYS,
    GRANT_BACKDATE_MINUTES,
    HIGH_SENSITIVITY,
)
from lakewarden.operators.identity import ID
from lakewarden.session import checkpoint, stored

GRANT_KEY = ["tenant_id", *ID, "grantee_type", "grantee", "effect"]


@dataclass(frozen=True)
class GrantConfig:
    auto_create: bool = False
    interval_minutes: int = 60
    marker: str = "policy-sync"


def rule_rows(policies: DataFrame) -> DataFrame:
    """One row per rule of `policies(id, name, enabled, rules)`; a repeated id counts once."""
    first = policies.groupBy("id").agg(F.min_by(F.struct("enabled", "rules"), "name").alias("p"))
    rules = first.select(
        F.col("id").alias("policy_id"), F.col("p.enabled").alias("enabled"), F.explode("p.rules").alias("r")
    )
    return rules.select(
        "policy_id", "enabled", "r.effect", "r.condition", "r.operations", "r.resources"
    )


def effective_rules(rules: DataFrame) -> DataFrame:
    """Data-access rules of enabled policies as `(policy_id, effect, resource)`.

    Takes rule rows (`rule_rows`, or a table of that shape). Conditional rules, other effects
    and rules without a data-read operation produce nothing.
    """
    effect = F.lower(F.btrim("effect"))
    operations = F.transform("operations", lambda o: F.lower(o))

    def reads(names: list[str]) -> Column:
        return F.arrays_overlap(operations, F.array(*[F.lit(n.lower()) for n in names]))

    unconditional = F.coalesce(F.btrim("condition"), F.lit("")) == ""
    allow = (effect == "allow") & reads(ALLOW_OPERATIONS)
    deny = (effect == "deny") & reads(DENY_OPERATIONS)
    return (
        rules.where(F.col("enabled") & unconditional & (allow | deny))
        .select(
            "policy_id",
            F.when(effect == "deny", F.lit("Deny")).otherwise(F.lit("Allow")).alias("effect"),
            F.explode(F.transform("resources", lambda x: F.lower(x))).alias("resource"),
        )
        .distinct()
    )


def rule_tables(rules: DataFrame, tables: DataFrame, salts: int = 32) -> DataFrame:
    """`(policy_id, effect, tenant_id, identity)` for every table a rule applies to.

    A table is addressable by three name forms and by the resource `table`, so all rules meet
    their tables in one equi-join. The resource `table` is one hot key holding every table; it
    is salted, with only the few rules on it repeated per salt.
    """
    full = F.lower(F.concat_ws(".", *ID))
    forms = F.array_distinct(
        F.array(
            F.lower("table_name"),
            F.lower(F.concat_ws(".", "schema_name", "table_name")),
            full,
            F.lit("table"),
        )
    )
    salt = F.pmod(F.xxhash64(full), F.lit(salts)).cast("int")
    keyed = tables.select("tenant_id", *ID, F.explode(forms).alias("resource")).withColumn(
        "__salt", F.when(F.col("resource") == "table", salt).otherwise(F.lit(0))
    )
    spread = F.when(F.col("resource") == "table", F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted = rules.withColumn("__salt", F.explode(spread))
    joined = salted.join(keyed, ["resource", "__salt"])
    return joined.select("policy_id", "effect", "tenant_id", *ID).distinct()


def resolve_policy_refs(refs: DataFrame, policies: DataFrame) -> DataFrame:
    """Policy id of every reference `(…, ref_id, ref_name)`: by id, else by a unique name."""
    ids = policies.select(F.col("id").alias("__pid")).distinct()
    names = (
        policies.where(F.coalesce("name", F.lit("")) != "")
        .groupBy(F.lower("name").alias("__name"))
        .agg(F.min("id").alias("__nid"), F.max("id").alias("__other"))
        .where(F.col("__nid") == F.col("__other"))
        .drop("__other")
    )
    joined = refs.join(ids, F.col("ref_id") == F.col("__pid"), "left").join(
        names, F.lower("ref_name") == F.col("__name"), "left"
    )
    rest = [c for c in refs.columns if c not in ("ref_id", "ref_name")]
    policy = F.coalesce("__pid", "__nid")
    return joined.select(*rest, policy.alias("policy_id")).where(F.col("policy_id").isNotNull())


def role_refs(roles: DataFrame) -> DataFrame:
    """`(role_id, role_name, ref_id, ref_name)` per policy reference of a role."""
    r = roles.select(
        F.col("id").alias("role_id"), F.col("name").alias("role_name"), F.explode("policies").alias("p")
    )
    return r.select(
        "role_id", "role_name", F.col("p.id").alias("ref_id"), F.col("p.name").alias("ref_name")
    )


def role_grantees(
    roles: DataFrame, policies: DataFrame, allowed: Mapping[str, str] | DataFrame
) -> DataFrame:
    """`(grantee_type, grantee, policy_id)` of roles on the allow-list, a mapping or `(role, grantee)`."""
    if not isinstance(allowed, DataFrame):
        allowed = roles.sparkSession.createDataFrame(list(allowed.items()), "role string, grantee string")
    names = allowed.select(F.lower("role").alias("__role"), F.btrim("grantee").alias("grantee"))
    names = names.where(F.coalesce("grantee", F.lit("")) != "")
    refs = role_refs(roles).join(names, F.lower("role_name") == F.col("__role"))
    resolved = resolve_policy_refs(refs.select("grantee", "ref_id", "ref_name"), policies)
    return resolved.select(F.lit("Role").alias("grantee_type"), "grantee", "policy_id")


def team_grantees(teams: DataFrame, policies: DataFrame) -> DataFrame:
    """Grantees of teams with a resolved `sid`."""
    t = teams.where(F.col("sid").isNotNull()).select(
        F.col("sid").alias("grantee"), F.explode("policies").alias("p")
    )
    refs = t.select("grantee", F.col("p.id").alias("ref_id"), F.col("p.name").alias("ref_name"))
    resolved = resolve_policy_refs(refs, policies)
    return resolved.select(F.lit("Group").alias("grantee_type"), "grantee", "policy_id")


def user_role_rows(users: DataFrame) -> DataFrame:
    """`(sid, role_id, role_name)` per role of `users(sid, roles)`."""
    held = users.select("sid", F.explode("roles").alias("r"))
    return held.select("sid", F.col("r.id").alias("role_id"), F.col("r.name").alias("role_name"))


def user_grantees(held: DataFrame, roles: DataFrame, policies: DataFrame) -> DataFrame:
    """Grantees of resolved users through their roles' policies.

    Takes role rows (`user_role_rows`, or a table of that shape); a role is found by its id,
    else by its name.
    """
    asked = held.where(F.col("sid").isNotNull()).select(
        F.col("sid").alias("grantee"),
        F.col("role_id").alias("__rid"),
        F.lower("role_name").alias("__rname"),
    )
    by_id = roles.select(F.col("id").alias("__id")).distinct()
    by_name = roles.groupBy(F.lower("name").alias("__name")).agg(F.min("id").alias("__nid"))
    found = (
        asked.join(by_id, F.col("__rid") == F.col("__id"), "left")
        .join(by_name, F.col("__rname") == F.col("__name"), "left")
        .select("grantee", F.coalesce("__id", "__nid").alias("role_id"))
        .where(F.col("role_id").isNotNull())
        .distinct()
    )
    refs = found.join(role_refs(roles), "role_id").select("grantee", "ref_id", "ref_name")
    resolved = resolve_policy_refs(refs, policies)
    return resolved.select(F.lit("User").alias("grantee_type"), "grantee", "policy_id")


def desired_grants(grantees: DataFrame, applicable: DataFrame) -> DataFrame:
    """Distinct grants `(GRANT_KEY, grantee_name)`; the grantee compares in upper case."""
    joined = grantees.distinct().join(applicable, "policy_id")
    return (
        joined.withColumn("__name", F.col("grantee"))
        .withColumn("grantee", F.upper("grantee"))
        .groupBy(*GRANT_KEY)
        .agg(F.min("__name").alias("grantee_name"))
    )


def auto_grantable(tables: DataFrame, columns: DataFrame) -> DataFrame:
    """Identities whose access may be granted without approval.

    `tables`: identity, `sensitivity`, `requires_four_eyes`; `columns`: identity,
    `is_sensitive`, `rule_type`.
    """
    level = F.upper(F.btrim(F.coalesce("sensitivity", F.lit("NORMAL"))))
    level = F.when(level == "", F.lit("NORMAL")).otherwise(level)
    open_tables = tables.where(
        ~F.coalesce("requires_four_eyes", F.lit(False))
        & level.isin(AUTO_GRANTABLE)
        & ~level.isin(HIGH_SENSITIVITY)
    ).select(*ID)
    protected = columns.where(
        F.coalesce("is_sensitive", F.lit(False)) | F.col("rule_type").isNotNull()
    ).select(*ID)
    return open_tables.join(protected, ID, "left_anti")


def effective_grants(desired: DataFrame, grantable: DataFrame, config: GrantConfig) -> DataFrame:
    """Denies, plus allows on grantable tables when automatic creation is on."""
    denies = desired.where(F.col("effect") == "Deny")
    if not config.auto_create:
        return denies
    allows = desired.where(F.col("effect") == "Allow").join(grantable, ID, "left_semi")
    return denies.unionByName(allows)


def reconcile_grants(
    effective: DataFrame,
    held: DataFrame,
    managed_tenants: DataFrame,
    config: GrantConfig,
    now: datetime,
) -> DataFrame:
    """One action per grant: keep, extend, revoke or create, with the resulting validity.

    `held`: `id`, `marker`, GRANT_KEY, `valid_to`. Only grants with the sync marker and of a
    managed tenant (`tenant_id`) are touched. Of several held copies of one grant the one with
    the smallest id stays; it is found by a combined minimum, never by gathering the copies.
    Both sides of the one comparison join then hold a grant once, so no key is hot in it.
    """
    scoped = _in_scope(held, managed_tenants, config, now)
    keepers = _held_once(scoped)
    copies = scoped.join(keepers.select(F.col("held.id").alias("id")), "id", "left_anti")
    wanted = effective.select(*GRANT_KEY, F.lit(True).alias("wanted"))
    return _actions(keepers.join(wanted, GRANT_KEY, "full_outer"), copies, config, now)


def _in_scope(held: DataFrame, managed_tenants: DataFrame, config: GrantConfig, now: datetime) -> DataFrame:
    """Held grants that the sync may touch."""
    at = F.lit(now).cast("timestamp")
    return (
        held.where((F.col("marker") == config.marker) & (F.col("valid_to") > at))
        .join(managed_tenants.select("tenant_id").distinct(), "tenant_id", "left_semi")
        .select("id", *GRANT_KEY[:-2], F.upper("grantee").alias("grantee"), "effect", "valid_to")
    )


def _held_once(scoped: DataFrame) -> DataFrame:
    """Each grant once, with the copy that stays as `held`."""
    return scoped.groupBy(*GRANT_KEY).agg(F.min(F.struct("id", "valid_to")).alias("held"))


def _actions(compared: DataFrame, copies: DataFrame, config: GrantConfig, now: datetime) -> DataFrame:
    """Actions for `(GRANT_KEY, held, wanted)`, and the copies revoked."""
    at = F.lit(now).cast("timestamp")
    minutes = 2 * max(1, config.interval_minutes)
    allow_to = at + F.make_interval(mins=F.lit(minutes))
    deny_to = at + F.make_interval(days=F.lit(DENY_VALID_DAYS))
    refresh = at + F.make_interval(days=F.lit(DENY_REFRESH_DAYS))
    from_time = at - F.make_interval(mins=F.lit(GRANT_BACKDATE_MINUTES))
    refreshed = (F.col("effect") == "Allow") | (F.col("held.valid_to") < refresh)
    action = (
        F.when(F.col("held").isNull(), F.lit("create"))
        .when(F.col("wanted").isNull(), F.lit("revoke"))
        .when(refreshed, F.lit("extend"))
        .otherwise(F.lit("keep"))
    )
    target = F.when(F.col("effect") == "Deny", deny_to).otherwise(allow_to)
    decided = compared.withColumn("action", action).select(
        "action",
        F.col("held.id").alias("id"),
        *GRANT_KEY,
        F.when(F.col("action") == "create", from_time).alias("valid_from"),
        F.when(F.col("action") == "revoke", at)
        .when(F.col("action") == "keep", F.col("held.valid_to"))
        .otherwise(target)
        .alias("valid_to"),
    )
    revoked = copies.select(
        F.lit("revoke").alias("action"),
        "id",
        *GRANT_KEY,
        F.lit(None).cast("timestamp").alias("valid_from"),
        at.alias("valid_to"),
    )
    return decided.unionByName(revoked)


def _set_name(*parts: str) -> Column:
    """Name of a set of distinct rows: its size and two sums of hashes, combined per task, never a list."""
    sums = [F.sum(F.xxhash64(F.lit(salt), *parts).cast("decimal(38,0)")).cast("string") for salt in (1, 2)]
    return F.concat_ws(":", F.count(F.lit(1)).cast("string"), *sums)


@dataclass(frozen=True)
class GrantClasses:
    """Wanted grants, unexpanded: grantees of a class hold the same policies, tables of a class have the same rules.

    `grantees` is `(grantee_type, grantee, gclass)`, `tables` is `(tenant_id, identity, tclass)`, and
    `pairs` is `(gclass, tclass, effect)`: every grantee of the one wants every table of the other.
    """

    grantees: DataFrame
    tables: DataFrame
    pairs: DataFrame


def grant_classes(
    grantees: DataFrame, rules: DataFrame, tables: DataFrame, grantable: DataFrame, config: GrantConfig
) -> GrantClasses:
    """Classes of grantees and of tables, and the pairs of classes that grants are wanted for.

    `rules` are effective rules. Those on the resource `table` hold for all tables, so they are
    the same for every class and are never joined to tables. Allows count only for grantable
    tables and with automatic creation on, denies always.
    """
    asked = checkpoint(
        grantees.select("grantee_type", F.upper("grantee").alias("grantee"), "policy_id").distinct()
    )
    who = checkpoint(asked.groupBy("grantee_type", "grantee").agg(_set_name("policy_id").alias("gclass")))
    one = who.groupBy("gclass").agg(F.min(F.struct("grantee_type", "grantee")).alias("r"))
    policies_of = one.select("gclass", "r.*").join(asked, ["grantee_type", "grantee"]).select("gclass", "policy_id")

    everywhere = F.col("resource") == "table"
    named = tables.select("tenant_id", *ID).distinct()
    own = checkpoint(rule_tables(rules.where(~everywhere), named))
    open_ids = grantable.select(*ID).distinct().withColumn("__open", F.lit(True))
    sets = own.groupBy("tenant_id", *ID).agg(_set_name("policy_id", "effect").alias("__set"))
    what = checkpoint(
        named.join(sets, ["tenant_id", *ID], "left")
        .join(open_ids, ID, "left")
        .select(
            "tenant_id",
            *ID,
            F.coalesce("__open", F.lit(False)).alias("__open"),
            F.concat_ws("|", F.coalesce("__set", F.lit("0")), F.coalesce("__open", F.lit(False)).cast("string")).alias("tclass"),
        )
    )
    first = what.groupBy("tclass", "__open").agg(F.min(F.struct("tenant_id", *ID)).alias("r"))
    own_rules = first.select("tclass", "__open", "r.*").join(own, ["tenant_id", *ID])
    common = rules.where(everywhere).select("policy_id", "effect").distinct()
    classes = first.select("tclass", "__open", F.lit(1).alias("__all"))
    of_all = classes.join(common.withColumn("__all", F.lit(1)), "__all")
    rules_of = own_rules.select("tclass", "__open", "policy_id", "effect").unionByName(
        of_all.select("tclass", "__open", "policy_id", "effect")
    )
    counts = (F.col("effect") == "Deny") | (F.col("__open") & F.lit(config.auto_create))
    pairs = policies_of.join(rules_of.where(counts).distinct(), "policy_id").select("gclass", "tclass", "effect").distinct()
    return GrantClasses(who, what.drop("__open"), checkpoint(pairs))


def expand_classes(classes: GrantClasses, pairs: DataFrame) -> DataFrame:
    """GRANT_KEY of every grant in these pairs of classes."""
    return pairs.join(classes.grantees, "gclass").join(classes.tables, "tclass").select(*GRANT_KEY)


def reconcile_classes(
    classes: GrantClasses, held: DataFrame, managed_tenants: DataFrame, config: GrantConfig, now: datetime
) -> DataFrame:
    """`reconcile_grants` by classes: the cost follows the held grants and the changes.

    A held grant is wanted if the classes of its grantee and table are a pair. A pair of classes
    of which as many grants are held as it has members lacks none; only the others are expanded
    and compared, so nothing grows with grantees times tables but the grants to create. Held
    grants are stored once, since finding the copies reads them again.
    """
    scoped = stored(_in_scope(held, managed_tenants, config, now), "held-grants")
    keepers = _held_once(scoped)
    placed = checkpoint(
        keepers.join(classes.grantees, ["grantee_type", "grantee"], "left")
        .join(classes.tables, ["tenant_id", *ID], "left")
        .join(classes.pairs.withColumn("wanted", F.lit(True)), ["gclass", "tclass", "effect"], "left")
    )
    copies = scoped.join(placed.select(F.col("held.id").alias("id")), "id", "left_anti")
    has = placed.where("wanted").groupBy("gclass", "tclass", "effect").agg(F.count(F.lit(1)).alias("has"))
    sizes = {
        name: frame.groupBy(name).agg(F.count(F.lit(1)).alias(f"{name}_n"))
        for name, frame in (("gclass", classes.grantees), ("tclass", classes.tables))
    }
    lacking = (
        classes.pairs.join(has, ["gclass", "tclass", "effect"], "left")
        .join(sizes["gclass"], "gclass")
        .join(sizes["tclass"], "tclass")
        .where(F.coalesce("has", F.lit(0)) < F.col("gclass_n") * F.col("tclass_n"))
        .select("gclass", "tclass", "effect")
    )
    missing = expand_classes(classes, lacking).join(placed.select(*GRANT_KEY), GRANT_KEY, "left_anti")
    compared = placed.select(*GRANT_KEY, "held", "wanted").unionByName(
        missing.withColumn("wanted", F.lit(True)), allowMissingColumns=True
    )
    return _actions(compared, copies, config, now)


def affected_tables(actions: DataFrame) -> DataFrame:
    """Distinct tables whose grants were created or revoked."""
    return actions.where(F.col("action").isin("create", "revoke")).select(*ID).distinct()

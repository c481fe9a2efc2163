"""Main text of web pages: blocks of the article, and boilerplate of a host found with a suffix array.

A page is read into blocks. Containers that are not the article (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, comments) are furniture: by element name, or by a whole name of their class, id or role. The rest is text: what
stands in `article`, `main` or role=main where a page has one, else all of the body. Articles are never furniture by a name,
headings neither, and what stands around a page's only article does not make it furniture by a name.

The pages of a host are then put together as one stream of tokens with a suffix array over it, sorted by their first
`RUN` tokens by rank doubling. Neighbours that agree on so many tokens are a repeated run; one that is on two or more
distinct pages of the host is boilerplate, and loose blocks that it covers wholly are removed, so the unique runs remain.
Loose are all blocks of a page without an article element, and in an article those outside of paragraphs, headings,
quotes, tables, list items of `RUN` tokens or more and the like, as a notice without a mark is. Paragraphs and headings of an article stay, also when other
pages repeat them: a quotation or a copied article is main text. Pages of equal text count as one page.

A host's pages are dealt by page to shards of about `PAGES`, so one large host is many tasks. Runs that pages of different
shards have are found by digests of all windows of `RUN` tokens: of each its least and largest page is kept, added up per task
first, and those of two pages go back to the shards that have them. So a page's text does not depend on the shards.

Defined results: null or empty html gives an empty text; a null or odd url makes a host of its own kind ('' ); repeated rows are
treated each; page ids may be null; unclosed and crossed elements are read as browsers do in outline (an end tag closes
what is open inside it); `br` is white space, not a block; extra columns are ignored.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakewarden.llm.common import pieces, stored, texts_of

#: Tokens of a repeated run.
RUN = 6
#: Pages of a host in one shard.
PAGES = 64

# Elements and words that decide what a container is.
FURNITURE = frozenset("nav header footer aside form script style noscript template iframe svg button select textarea head title dialog object canvas menu".split())
RAW = frozenset("script style textarea title noscript iframe template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav "
    "ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising adbox banner sponsor sponsored promo promotion sidebar side-bar menu nav navbar navigation breadcrumb breadcrumbs header "
    "footer notice notices cookie cookies consent gdpr popup modal overlay newsletter subscribe subscription signup share sharing social related recommended comment comments "
    "reply replies disqus respond alert masthead topbar toolbar widget pagination pager complementary contentinfo search".split()
)
#: Compounds that name furniture: a mark between one of the first and one of the last, each left out or not.
COMPOUND = frozenset("site page main top bottom left right primary secondary global social cookie nav navigation menu footer ad ads".split())
COMPOUND_END = frozenset("box bar banner container wrapper block slot unit area list section form links buttons menu nav posts articles items content inner header footer consent notice".split())
MAIN = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre table caption th td dl dt dd figcaption summary".split())

_START = re.compile(r"<(?=!|\?|/?[a-zA-Z])")
_ELEMENT = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""")
_UNQUOTED = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, a, b, c in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), a or b or c)
    return found


def _is_mark(name: str) -> bool:
    if name in MARKS:
        return True
    parts = re.split(r"[-_:]+", name)
    for i, part in enumerate(parts):
        if part in MARKS and (len(parts) == 1 or all(p in COMPOUND or p in MARKS for p in parts[:i]) and all(p in COMPOUND_END or p in MARKS for p in parts[i + 1 :])):
            return True
    return False


def _is_hidden(own: dict[str, str]) -> bool:
    return own.get("hidden", "false").lower() != "false" or own.get("aria-hidden", "").lower() == "true" or bool(_NOT_SHOWN.search(own.get("style", "")))


def _is_furniture(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is furniture, and whether only by the names that it has."""
    if tag in FURNITURE:
        return True, False
    if not attributes or tag in ("html", "body"):
        return False, False
    own = _attributes(attributes)
    if _is_hidden(own):
        return True, False
    if tag in HEADINGS or _is_main(tag, attributes):
        return False, False
    named = any(_is_mark(name) for key in ("class", "id", "role") for name in own.get(key, "").lower().split())
    return named, named


def _is_main(tag: str, attributes: str) -> bool:
    return tag in MAIN or ("role" in attributes.lower() and _attributes(attributes).get("role", "").lower() == "main")


class Tags:
    """Tags of a page, in time linear in its length however broken it is.

    A tag ends at the first > outside quotes. Once quotes leave a tag without an end they count no more, here and in all tags
    after it. What follows a < of a tag that has no > at all is cut off, to the end of the page.
    """

    def __init__(self, page: str):
        self.page, self.quotes = page, True

    def find(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start and end of the next tag, a slash for an end tag, its name (none for comments and the like) and attributes."""
        found = _START.search(self.page, at)
        if found is None:
            return None
        start, page = found.start(), self.page
        if page[start + 1] in "!?":
            end = page.find("-->", start + 4) + 2 if page.startswith("<!--", start) else page.find(">", start)
            return start, end + 1 if end > start else len(page), "", "", ""
        tag = _ELEMENT.match(page, start) if self.quotes else None
        if tag is None:
            self.quotes = False
            tag = _UNQUOTED.match(page, start)
        if tag is None:
            return start, len(page), "", "", ""
        return start, tag.end(), tag[1], tag[2].lower(), tag[3]


def _without_tags(text: str) -> str:
    closed = text.rfind(">") + 1
    return re.sub(r"<[^>]*>", " ", text[:closed]) + text[closed:]


def blocks(page: str) -> tuple[list[str], list[bool], list[str]]:
    """(text blocks, whether each is loose, furniture blocks).

    Text blocks are those inside article elements if there are any, else those of the body.
    """
    open_tags: list[tuple[str, bool, bool, bool]] = []  # name, furniture, main, furniture by a name around the article
    out: list[tuple[str, bool, bool, bool, bool]] = []
    run: list[str] = []
    opened: Counter[str] = Counter()
    block_at: list[int] = []  # where in open_tags the blocks are
    furniture = inside = around = prose = 0
    has_main = False
    wrapped = 0  # articles that only names of what is around them make furniture

    def flush() -> None:
        if run:
            text = " ".join(html.unescape("".join(run)).split())
            if text:
                item = inside > 0 and len(text.split()) >= RUN and opened["li"] > 0
                out.append((text, furniture > 0, around > 0, inside > 0, not item and not prose))
            run.clear()

    def close(upto: int) -> None:
        nonlocal furniture, inside, around, prose
        while len(open_tags) > upto:
            name, f, m, a = open_tags.pop()
            opened[name] -= 1
            prose -= name in PROSE
            if name in BLOCK:
                block_at.pop()
            furniture -= f
            inside -= m
            around -= a

    at, end, tags = 0, len(page), Tags(page)
    while at < end:
        tag = tags.find(at)
        if tag is None:
            run.append(page[at:])
            break
        start, after, slash, name, attributes = tag
        if start > at:
            run.append(page[at:start])
        at = after
        if not name:
            continue
        if slash:
            if opened[name]:
                i = next(i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] == name)
                if name in BLOCK or any(t in BLOCK or f or a for t, f, _, a in open_tags[i:]):
                    flush()
                close(i)
            elif name in BLOCK:
                flush()
            continue
        if name in VOID:
            if name in BLOCK:
                flush()
            elif name == "br":
                run.append(" ")
            continue
        (f, named), m = _is_furniture(name, attributes), _is_main(name, attributes)
        a = named and not inside
        if name in BLOCK or f or m:
            flush()
        if name in BLOCK and block_at and open_tags[block_at[-1]][0] == "p":
            close(block_at[-1])
        if name in ("li", "td", "th", "tr", "dt", "dd") and opened[name]:
            for i in reversed(block_at):
                if open_tags[i][0] == name:
                    close(i)
                    break
                if open_tags[i][0] in ("ul", "ol", "table", "dl"):
                    break
        if attributes.endswith("/") and name not in BLOCK and name not in RAW:
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
            if name in ("noscript", "textarea", "title") and stop:
                text = " ".join(html.unescape(_without_tags(page[at : stop.start()])).split())
                if text:
                    out.append((text, True, False, inside > 0, True))
            at = stop.end() if stop else end
            continue
        f = f and not a
        has_main |= m and not furniture and not around and not f
        wrapped += m and not furniture and around > 0 and not inside and not f
        if name in BLOCK:
            block_at.append(len(open_tags))
        open_tags.append((name, f, m, a))
        opened[name] += 1
        prose += name in PROSE
        furniture += f
        inside += m
        around += a
    flush()
    only = not has_main and wrapped == 1
    has_main |= only
    marked = [(t, f or (a and not (only and m)), m, loose) for t, f, a, m, loose in out]
    text = [(t, loose or not has_main) for t, f, m, loose in marked if not f and (m or not has_main)]
    return [t for t, _ in text], [x for _, x in text], [t for t, f, m, _ in marked if f or (has_main and not m)]


def suffix_order(ids: np.ndarray, length: int) -> np.ndarray:
    """Rank of every position by its first `length` tokens; equal ranks mean equal tokens.

    Ranks double in length each round. The last round looks back so far that exactly `length` tokens count. Positions
    alone in their rank are settled and left out of later rounds.
    """
    _, which, counts = np.unique(ids, return_inverse=True, return_counts=True)
    # a rank is the number of positions before its group, so settled ranks stay as they are
    rank = (np.cumsum(counts) - counts)[which]
    n, have = len(ids), 1
    live = np.flatnonzero(counts[which] > 1)
    while have < length and len(live):
        step = min(have, length - have)
        nxt = np.where(live + step < n, rank[np.minimum(live + step, n - 1)] + 1, 0)
        order = np.lexsort((nxt, rank[live]))
        r, x = rank[live][order], nxt[order]
        new_group = np.concatenate([[True], r[1:] != r[:-1]])
        new_pair = new_group | np.concatenate([[True], x[1:] != x[:-1]])
        place = np.arange(len(live))
        group = np.maximum.accumulate(np.where(new_group, place, 0))
        pair = np.maximum.accumulate(np.where(new_pair, place, 0))
        rank[live[order]] = r + pair - group
        size = np.bincount(np.cumsum(new_pair) - 1)
        live = np.sort(live[order][np.repeat(size > 1, size)])
        have += step
    return rank


def counted_blocks(text: list[str], loose: list[bool], other: list[str]) -> list[tuple[str, bool]]:
    """The blocks of a page in the order of its stream of tokens, and whether they are in it."""
    return [*zip(text, loose, strict=True), *((o, True) for o in other)]


def window_digests(words: list[str], host: str, run: int = RUN) -> np.ndarray:
    """A digest of host and tokens for every window of `run` tokens of a page's stream."""
    n = len(words) - run + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    h = np.fromiter((xxhash.xxh64_intdigest(w) for w in words), np.uint64, len(words))
    out = np.full(n, xxhash.xxh64_intdigest(host), np.uint64)
    for i in range(run):
        out = (out ^ h[i : n + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return out


def host_boilerplate(pages: list[tuple[list[str], list[bool], list[str]]], run: int = RUN, host: str = "", elsewhere: np.ndarray | None = None) -> list[list[bool]]:
    """For each page, whether each text block is boilerplate of the host.

    `elsewhere` are digests of windows that are on two or more pages of the host, in whichever shards.
    """
    names: dict[str, int] = {}
    same: dict[tuple, int] = {}
    ids, page_of, spans, known = [], [], [], []
    stop = -1
    for text, loose, other in pages:
        page, own, first = same.setdefault(tuple(text), len(same)), [], len(ids)
        words: list[str] = []
        for block, counts in counted_blocks(text, loose, other):
            start = len(ids)
            if counts:
                words += block.split()
                ids += [names.setdefault(w, len(names)) for w in block.split()]
            own.append((start, len(ids)))
        if elsewhere is not None and len(elsewhere):
            known.append(first + np.flatnonzero(np.isin(window_digests(words, host, run), elsewhere)))
        # nothing runs on from one page into another
        ids.append(stop)
        page_of += [page] * (len(ids) - len(page_of))
        stop -= 1
        spans.append(own[: len(text)])
    if not ids:
        return []
    ids, page_of = np.array(ids), np.array(page_of)
    rank = suffix_order(ids, run)
    order = np.argsort(rank, kind="stable")
    r = rank[order]
    starts = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
    # a run with a stop in it occurs once, so it is never on two pages
    repeated = np.minimum.reduceat(page_of[order], starts) != np.maximum.reduceat(page_of[order], starts)
    at = np.unique(np.concatenate([order[np.repeat(repeated, np.diff(np.append(starts, len(ids))))], *known]))
    edge = np.zeros(len(ids) + run + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + run, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(edge)[: len(ids)] > 0)])
    return [[b > a and covered[b] - covered[a] == b - a for a, b in own] for own in spans]


PARSED = "page_id long, url string, host string, text array<string>, loose array<boolean>, other array<string>"
RESULT = "page_id long, url string, text string, n_chars long"


def parse(pages: DataFrame) -> DataFrame:
    def read(batches):
        for batch in pieces(batches, "html"):
            made = [blocks(page) for page in texts_of(batch, "html")]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("page_id"),
                    batch.column("url"),
                    batch.column("host"),
                    pa.array([t for t, _, _ in made], pa.list_(pa.string())),
                    pa.array([x for _, x, _ in made], pa.list_(pa.bool_())),
                    pa.array([o for _, _, o in made], pa.list_(pa.string())),
                ],
                names=["page_id", "url", "host", "text", "loose", "other"],
            )

    host = host_of(F.col("url"))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), F.col("html").cast("string").alias("html")).mapInArrow(read, PARSED)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def windows(dealt: DataFrame) -> DataFrame:
    """(host, shard, digest, least, largest): the windows of a batch's pages, and the least and largest key of pages that have them."""

    def read(batches):
        for batch in batches:
            digests, keys, groups = [], [], []
            names: dict[tuple[str, int], int] = {}
            for text, loose, other, host, shard in zip(*(batch.column(c).to_pylist() for c in ("text", "loose", "other", "host", "shard")), strict=True):
                words = [w for block, counts in counted_blocks(text, loose, other) if counts for w in block.split()]
                own = np.unique(window_digests(words, host)).astype(np.int64)
                digests.append(own)
                keys.append(np.full(len(own), xxhash.xxh64_intdigest("\n".join(text)), np.uint64).astype(np.int64))
                groups.append(np.full(len(own), names.setdefault((host, shard), len(names)), np.int64))
            if digests and sum(map(len, digests)):
                digest, key, group = (np.concatenate(c) for c in (digests, keys, groups))
                order = np.lexsort((key, digest, group))
                digest, key, group = digest[order], key[order], group[order]
                first = np.flatnonzero(np.concatenate([[True], (digest[1:] != digest[:-1]) | (group[1:] != group[:-1])]))
                last = np.append(first[1:], len(digest)) - 1
                of, which = list(names), group[first].tolist()
                made = [pa.array([of[g][0] for g in which], pa.string()), pa.array([of[g][1] for g in which], pa.int64())]
                # the largest key is left out where it is the least
                made += [pa.array(digest[first]), pa.array(key[first]), pa.array(key[last], mask=key[first] == key[last])]
                yield pa.RecordBatch.from_arrays(made, names=["host", "shard", "digest", "least", "largest"])

    return dealt.mapInArrow(read, "host string, shard long, digest long, least long, largest long")


def repeated_windows(dealt: DataFrame) -> DataFrame:
    """(host, shard, digests) of the windows that two or more distinct pages of a host have, for each shard that has them."""
    # dealt by the digest once, so that pages are parsed once for both steps
    every = windows(dealt).repartition("digest").groupBy("host", "shard", "digest").agg(F.min("least").alias("least"), F.max(F.coalesce("largest", "least")).alias("largest"))
    same = Window.partitionBy("digest")
    spread = every.select("host", "shard", "digest", F.min("least").over(same).alias("least"), F.max("largest").over(same).alias("largest"))
    # a shard's digests go as few arrays, not as rows with its name
    return spread.filter("least <> largest").groupBy("host", "shard").agg(F.collect_list("digest").alias("digests"))


def main_text(pages: DataFrame, per_shard: int = PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    host = host_of(F.col("url"))
    # as a table its size is known, so that pages are not shuffled to meet a few hosts
    large = stored(pages.groupBy(host.alias("large")).agg(F.count("*").alias("pages")).filter(F.col("pages") > per_shard), "page-hosts")
    shards = F.coalesce(F.ceil(F.col("pages") / per_shard), F.lit(1))
    shard = F.pmod(F.xxhash64("page_id", "url"), shards)
    dealt = parse(pages).join(large, F.col("host") == F.col("large"), "left").withColumn("shard", shard).drop("large", "pages")
    # a host of one shard needs no digests
    of_large = parse(pages.join(large, host == F.col("large"), "left_semi")).join(large, F.col("host") == F.col("large")).withColumn("shard", shard)
    across = repeated_windows(of_large.select("host", "shard", "text", "loose", "other"))

    def unique(key: tuple, group: pd.DataFrame, elsewhere: pd.DataFrame) -> pd.DataFrame:
        pages = [(list(t), list(x), list(o)) for t, x, o in zip(group["text"], group["loose"], group["other"], strict=True)]
        gone = host_boilerplate(pages, host=key[0], elsewhere=np.concatenate([np.zeros(0, np.int64), *elsewhere["digests"]]).astype(np.int64).view(np.uint64))
        text = ["\n".join(t for t, g in zip(p[0], g, strict=True) if not g) for p, g in zip(pages, gone, strict=True)]
        return pd.DataFrame({"page_id": group["page_id"].astype("Int64"), "url": group["url"], "text": text, "n_chars": [len(t) for t in text]})

    return dealt.groupBy("host", "shard").cogroup(across.groupBy("host", "shard")).applyInPandas(unique, RESULT)


def query(spark, sf_dir: str) -> DataFrame:
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))

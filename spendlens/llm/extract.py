"""Main text of web pages by templates deduced from pages of the same host.

Tokens of a page are the paths of its elements and, for each block, its path with its text. A host's contents are its
pages' free texts (not aside, not mostly links); copies are one content. Tokens of a host that occur equally often in
every content have one occurrence vector and form an equivalence class; a vector is compared by its number of contents
and the exclusive or of hashes of content and count, so vectors are never gathered, and a class needs one row per
(host, token), folded on the map side. A class is valid for a page if it is on at least half of at least MIN_PAGES contents
and the page shows all its texts in the order of the class. Valid classes nest by their paths into the host's template:
elements are its frame, texts that repeat are its fixed text, and what is left of a page are its slots. The slot with the
article is the smallest element, once on each of its pages and in a class on half of them, that holds all varying text
without links; where markup names articles with varying text, all of that. A path repeated within a page and a single
paragraph, heading or cell are never the slot.

A page gives the blocks of the article's slot; menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles and reader comments are left out by their markup wherever they stand, fixed text only outside of a named
article. Within the slot, markup that names the article has the last word, also on a page without the slot. A page of
which fixed text is more than three quarters is a copy and keeps it. Hosts of fewer contents than MIN_PAGES have no
template: there the page's own markup decides.

Cases: null and empty html give an empty text. Pages without a host have no template. Repeated rows are pages of
their own. Extra columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlens.llm import common
from spendlens.llm.markup import Block, blocks
from spendlens.session import apply_settings

MIN_PAGES = 4
SUPPORT = 0.5  # of the contents of a host that have a valid class
OPTIONAL = 0.1  # of the contents that have an element whose text counts for the slot
COPIED = 0.25  # a page that keeps less than this of its free text is a copy
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote tr td th caption figcaption".split())
LINKED = 0.5  # share of links from which a block is a menu
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"

TOKENS = "host string, content long, token long, path string, is_text boolean, n long, chars long, named boolean, place double"
_NAMES = ["host", "content", "token", "path", "is_text", "n", "chars", "named", "place"]
_TYPES = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.float64()]
_EMPTY = pa.RecordBatch.from_arrays([pa.array([], t) for t in _TYPES], names=_NAMES)


def host_of(url: str = "url") -> F.Column:
    return F.coalesce(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def _token(path: str, text: str = "") -> int:
    return xxhash.xxh64_intdigest(f"{path}\0{text}") - 2**63


def _is_free(block: Block) -> bool:
    return not block.aside and block.linked < LINKED * len(block.text)


def _token_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per page: each token with its count, its place and the free text it holds; the empty path is the page."""
    for batch in batches:
        rows = []
        for host, html in zip(*(batch.column(i).to_pylist() for i in range(2))):
            found, paths = blocks(html or "")
            content = xxhash.xxh64_intdigest("\n".join(b.text for b in found if _is_free(b))) - 2**63
            own: Counter[str] = Counter()
            for block in found:
                if _is_free(block):
                    own[block.path] += len(block.text)
            main = {b.path for b in found if b.main and not b.aside}
            counts = Counter(paths) | Counter({b.path: 1 for b in found})
            counts[""] = 1
            rows.extend((host, content, _token(p), p, False, n, own[p], p in main, 0.0) for p, n in counts.items())
            place: dict[tuple[str, str], int] = {}
            many: Counter[tuple[str, str]] = Counter()
            free: Counter[tuple[str, str]] = Counter()
            for i, b in enumerate(found):
                key = b.path, b.text
                place.setdefault(key, i)
                many[key] += 1
                free[key] += len(b.text) * _is_free(b)
            rows.extend((host, content, _token(*k), k[0], True, n, free[k], False, place[k] / len(found)) for k, n in many.items())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES) if rows else _EMPTY


def templates(pages: DataFrame) -> DataFrame:
    """One row per host with a template: host, frame (elements), fixed (repeated texts, each with its class and place).

    Pages of the same free text count once, so copies of an article do not make it a template. Texts are on half of the
    host's contents, elements on OPTIONAL of them, so both lists are as long as a few pages.
    """
    rows = common.through_arrow(pages.select(host_of().alias("host"), "html"), _token_batches, TOKENS)
    rows = rows.where("host <> ''").groupBy("host", "content", "token").agg(
        F.min("path").alias("path"), F.max("is_text").alias("is_text"), F.max("n").alias("n"), F.max("chars").alias("chars"),
        F.max("named").alias("named"), F.min("place").alias("place"),
    )
    sums = rows.groupBy("host", "token").agg(
        F.min("path").alias("path"), F.max("is_text").alias("is_text"), F.count("*").alias("pages"), F.sum("n").alias("count"),
        F.sum("chars").alias("chars"), F.max("named").alias("named"), F.avg("place").alias("place"),
        F.bit_xor(F.xxhash64("content", "n")).alias("vector"),
    )
    sums = common.kept(sums.where("pages > 1 OR path = ''"))
    sizes = sums.where("path = '' AND NOT is_text").where(F.col("pages") >= MIN_PAGES).select("host", F.col("pages").alias("size"))
    share = F.when(F.col("is_text"), SUPPORT).otherwise(OPTIONAL)
    valid = sums.join(sizes, "host").where(F.col("pages") >= share * F.col("size"))
    kind = F.xxhash64("pages", "vector")
    frame = F.struct("path", "pages", "size", "count", "chars", "named", kind.alias("kind"))
    fixed = F.struct("token", kind.alias("kind"), "place", "path", "chars")
    return valid.groupBy("host").agg(
        F.array_sort(F.collect_list(F.when(~F.col("is_text"), frame))).alias("frame"),
        F.array_sort(F.collect_list(F.when(F.col("is_text"), fixed))).alias("fixed"),
    )


def varying(frame: list[dict], fixed: list[dict]) -> list[dict]:
    """The frame with the characters of each element that are not fixed text."""
    known: Counter[str] = Counter()
    for f in fixed:
        known[f["path"]] += f["chars"]
    return [{**f, "chars": f["chars"] - known[f["path"]]} for f in frame]


def slot_of(frame: list[dict]) -> str:
    """The smallest container that holds all varying text: one element of a class on half of the contents, once each.

    Where some of the text is in named articles, it is the container of these.
    """
    holders = [f for f in frame if f["chars"] > 0]
    holders = [f for f in holders if f["named"]] or holders
    if not holders:
        return ""
    parts = [f["path"].split("/") for f in holders]
    shared = parts[0]
    for p in parts[1:]:
        shared = shared[: next((i for i, (x, y) in enumerate(zip(shared, p)) if x != y), min(len(shared), len(p)))]
    once = {f["path"] for f in frame if f["count"] == f["pages"] and f["pages"] >= SUPPORT * f["size"]}
    while len(shared) > 1 and ("/".join(shared) not in once or shared[-1].split(".")[0] in LEAVES):
        shared = shared[:-1]
    return "/".join(shared)


def _shown(found: list[Block], fixed: list[dict]) -> set[int]:
    """The fixed texts whose class the page shows whole and in its order."""
    place: dict[int, int] = {}
    for i, b in enumerate(found):
        place.setdefault(_token(b.path, b.text), i)
    classes: dict[int, list[dict]] = {}
    for f in fixed:
        classes.setdefault(f["kind"], []).append(f)
    out: set[int] = set()
    for tokens in classes.values():
        at = [place.get(f["token"], -1) for f in sorted(tokens, key=lambda f: (f["place"], f["token"]))]
        if min(at) >= 0 and all(x < y for x, y in zip(at, at[1:])):
            out.update(f["token"] for f in tokens)
    return out


def article(found: list[Block], frame: list[dict], fixed: set[int]) -> list[str]:
    """The blocks of the article's slot."""
    left = [b for b in found if not b.aside]
    slot = slot_of(frame)
    inside = [b for b in left if b.path == slot or b.path.startswith(slot + "/")] or left
    if any(b.main for b in inside):  # the check by markup: what it names is the article, repeated or not
        return [b.text for b in inside if b.main]
    free = [b for b in inside if _is_free(b)]
    kept = [b for b in free if _token(b.path, b.text) not in fixed]
    if COPIED * sum(len(b.text) for b in free) > sum(len(b.text) for b in kept):
        kept = free  # nearly all of it is on other pages: an article with copies, not a frame
    return [b.text for b in kept]


EXTRACTED = "page_id long, url string, text string, n_chars long"


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, frame, fixed in zip(*(batch.column(n).to_pylist() for n in ("html", "frame", "fixed"))):
            found = blocks(html or "")[0]
            texts.append("\n".join(article(found, varying(frame or [], fixed or []), _shown(found, fixed or []))))
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and its number of characters for every row."""
    known = common.kept(templates(pages))
    rows = pages.select(F.col("page_id").cast("long"), "url", "html", host_of().alias("host")).join(known, "host", "left")
    return common.through_arrow(rows.select("page_id", "url", "html", "frame", "fixed"), _text_batches, EXTRACTED)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    return extracted(common.read(spark, sf_dir, "pages"))

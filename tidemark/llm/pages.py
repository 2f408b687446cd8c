"""Main text of web pages: marked structure, and a suffix array per host.

A page is read as blocks. Blocks of menus, forms, adverts and the like are
left out by their tags, roles and names. Where the page marks its article, and
the article is the better part of it, the article's blocks are its text.

Repetition decides the rest, and it is asked first: open text that it cuts
does not weigh against the article. Whatever stands outside articles makes the
host's token stream. Its suffixes are sorted, and neighbours tell how long a run of
tokens a suffix shares with another page. A long run that two pages share is
boilerplate, a short one if a fair share of all pages of the host has it: a
share that does not shrink as the host grows. On pages without such an article these
runs are cut out, and the unique runs are kept beside the article. In articles,
only whole blocks go, if that share of the pages has them.

Equal suffixes are merged where they arise, so a host's menu costs a task one
row per token however many pages carry it.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import stored

# Elements by what they do to the text.
BLOCKS = set(
    "address article aside blockquote body br button caption center dd details dialog div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol option p pre section select"
    " summary table tbody td tfoot th thead tr ul".split()
)
# Elements whose content is not text of the page, whatever is in it.
OPAQUE = set("script style noscript template textarea svg math iframe object canvas audio video title".split())
CHROME = set("nav footer aside form button select dialog menu head header".split())
CHROME_ROLES = set("navigation banner contentinfo complementary search form dialog alert menu toolbar".split())
CHROME_NAMES = set(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie"
    " cookies disclaimer disqus footer form login masthead menu modal nav navbar navigation newsletter notice notices"
    " popup promo promoted related replies reply share sharing sidebar signup social sponsor sponsored subscribe toolbar"
    " widget widgets".split()
)
# Words that say where such an element is, not what.
PLACES = set(
    "area bar block bottom box col column container content global group head inner item left list main mobile outer page"
    " panel primary right row secondary section side site slot top unit wrap wrapper zone".split()
)
# A class that begins so tells what the page has, not what the element is.
LAYOUT = ("has-", "is-", "no-", "with-", "without-")
# Elements that an article's own head may be.
HEADS = {"header"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ARTICLE, MAIN = "article", "main"

# Quotes may hold the end of a tag. Where they do not come in pairs, a tag ends at the next one's start.
_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)([^<>]*+)>")
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_CLOSES = {tag: re.compile(f"</{tag}\\s*>", re.IGNORECASE) for tag in OPAQUE}
_UNSEEN = re.compile(r"display\s*:\s*none", re.IGNORECASE)
_WORD = re.compile(r"[^a-z0-9]+")


def attributes_of(text: str) -> dict[str, str]:
    """Names in lower case and values; of a name that comes twice, the first."""
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return found


def names_chrome(name: str) -> bool:
    """Whether a class or id, as a whole, names a part of the page's frame."""
    if name.startswith(LAYOUT):
        return False
    words = set(_WORD.split(name)) - {""}
    return bool(words & CHROME_NAMES) and words <= CHROME_NAMES | PLACES


def _is_chrome(tag: str, text: str, inside: bool) -> bool:
    if tag in CHROME and not (inside and tag in HEADS):
        return True
    if not text or tag in ("html", "body", MAIN):
        return False
    attributes = attributes_of(text)
    names = [n for a in ("class", "id") for n in attributes.get(a, "").lower().split()]
    if tag == ARTICLE:
        # Only plain names: an article's own class may speak of its comments.
        return bool(set(names) & {"comment", "reply", "related", "promo", "sponsored", "ad"})
    unseen = "hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true"
    if unseen or _UNSEEN.search(attributes.get("style", "")):
        return True
    if set(attributes.get("role", "").lower().split()) & CHROME_ROLES:
        return True
    return any(map(names_chrome, names))


def tags(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """``start, end, slash, name, attributes`` of every tag.

    Comments, declarations and whole opaque elements come without a name. One
    pass: a tag whose end is not found is searched to the end of the page once,
    and from then on quotes are not trusted.
    """
    at, pattern = page.find("<"), _TAG
    while at >= 0:
        end = at + 1
        if page.startswith("<!--", at):
            close = page.find("-->", at + 4)
            end = close + 3 if close >= 0 else len(page)
            yield at, end, "", "", ""
        elif page.startswith(("<!", "<?"), at):
            close = page.find(">", at)
            end = close + 1 if close >= 0 else len(page)
            yield at, end, "", "", ""
        elif at + 1 < len(page) and (page[at + 1] == "/" or page[at + 1].isascii() and page[at + 1].isalpha()):
            m = pattern.match(page, at)
            if m is None and pattern is _TAG and re.compile("</?[a-zA-Z]").match(page, at):
                pattern = _LOOSE
                m = pattern.match(page, at)
            if m is not None:
                end, name = m.end(), m[2].lower()
                if name in OPAQUE:
                    # Inside of it, only its own end counts.
                    if not m[1] and not m[3].endswith("/"):
                        close = _CLOSES[name].search(page, end)
                        end = close.end() if close else len(page)
                    yield at, end, "", "", ""
                else:
                    yield at, end, m[1], name, m[3]
        at = page.find("<", end)


Block = tuple[str, str]


def read_blocks(page: str) -> list[Block]:
    """``zone, text`` of each block: zone ``article``, ``open`` or ``chrome``.

    Text is decoded, white space in a block is one space. Broken markup is read
    on as well as it goes: what is never closed ends with the page, and chrome
    that was opened outside an article ends where an article begins.
    """
    blocks: list[Block] = []
    held: list[str] = []
    article = skipped = 0
    skipping = ""
    at = 0

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            blocks.append(("chrome" if skipping else "article" if article else "open", text))

    def take(piece: str) -> None:
        if piece:
            held.append(entities.unescape(piece) if "&" in piece else piece)

    for start, end, closing, tag, attributes in tags(page):
        take(page[at:start])
        at = end
        if not tag:
            continue
        if tag in BLOCKS or tag in CHROME:
            flush()
        starts_article = tag == ARTICLE or tag == MAIN
        if closing:
            if skipping and tag == skipping:
                skipped -= 1
                if not skipped:
                    flush()
                    skipping = ""
            elif starts_article and article and not skipping:
                article -= 1
            continue
        if tag in VOID or attributes.endswith("/"):
            continue
        if skipping:
            if starts_article and not article and not _is_chrome(tag, attributes, True):
                skipping = ""
            else:
                skipped += tag == skipping
                continue
        if _is_chrome(tag, attributes, bool(article)):
            flush()
            skipping, skipped = tag, 1
        elif starts_article:
            article += 1
    # A tag that the page breaks off in is no text.
    rest = page[at:]
    take(rest[: rest.rfind("<")] if re.search(r"<[a-zA-Z/!][^>]*\Z", rest) else rest)
    flush()
    return blocks


def has_article(blocks: list[Block], open_size: int | None = None) -> bool:
    """Whether the page marks an article that holds no less text than what is around it.

    ``open_size``: what of the open text repetition leaves; all of it if not given.
    A teaser in front of an unmarked body does not speak for the page.
    """
    sizes = dict.fromkeys(("article", "open", "chrome"), 0)
    for zone, text in blocks:
        sizes[zone] += len(text)
    return sizes["article"] > 0 and sizes["article"] >= (sizes["open"] if open_size is None else open_size)


TOKEN = 4  # bytes that stand for a token in a suffix


def outside_tokens(blocks: list[Block], zones: tuple[str, ...]) -> tuple[list[str], list[int]]:
    """Tokens of the blocks in ``zones``, in order, and each one's block."""
    tokens: list[str] = []
    block_of: list[int] = []
    for i, (zone, text) in enumerate(blocks):
        if zone in zones:
            words = text.split(" ")
            tokens += words
            block_of += [i] * len(words)
    return tokens, block_of


def suffixes(tokens: list[str], depth: int) -> list[bytes]:
    """The first ``depth`` tokens of each suffix, each token as a checksum."""
    codes = b"".join(zlib.crc32(t.encode("utf-8", "replace")).to_bytes(TOKEN, "big") for t in tokens)
    return [codes[i * TOKEN : (i + depth) * TOKEN] for i in range(len(tokens))]


def _common(a: bytes, b: bytes) -> int:
    n = min(len(a), len(b)) // TOKEN
    for i in range(n):
        if a[i * TOKEN : (i + 1) * TOKEN] != b[i * TOKEN : (i + 1) * TOKEN]:
            return i
    return n


class Neighbours:
    """Walks a host's suffixes in sorted order, and says how much of each an earlier one of another page has.

    A neighbour may be of the same page, so what the nearest one of another
    page shares is carried along; nothing else is held.
    """

    def __init__(self) -> None:
        self.before: bytes | None = None
        self.page: int | None = None
        self.near = self.far = 0

    def step(self, suffix: bytes, low: int, high: int) -> int:
        """``low`` and ``high``: the lowest and highest page that has the suffix."""
        page = low if low == high else None
        found = 0
        if self.before is not None:
            common = _common(self.before, suffix)
            self.near, self.far = min(self.near, common), min(self.far, common)
            found = self.near if self.page is None or self.page != page else self.far
            if self.page is None or self.page != page:
                # What was near is of another page than this one.
                self.far = self.near
        self.before, self.page, self.near = suffix, page, len(suffix) // TOKEN
        return found if low == high else self.near


def shared_depths(rows: list[tuple[bytes, int, int]]) -> list[int]:
    """For each suffix of one host in sorted order, how much of it another page shares."""
    up, down = Neighbours(), Neighbours()
    forth = [up.step(*row) for row in rows]
    back = [down.step(*row) for row in reversed(rows)]
    return list(map(max, forth, reversed(back)))


_SUFFIX = pa.schema(
    [("host", pa.int64()), ("page", pa.int64()), ("position", pa.int32()), ("suffix", pa.binary()), ("loose", pa.bool_())]
)
SUFFIX = "host long, page long, position int, suffix binary, loose boolean"


def stream_zones(blocks: list[Block]) -> tuple[str, ...]:
    """What of a page is in its host's token stream: all but its article, whose blocks are judged whole."""
    return ("open", "chrome")


def _suffix_rows(depth: int):
    """The suffixes of each page's part of the stream; ``loose`` are those of pages with open text."""

    def emit(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out: list[list] = [[], [], [], [], []]
            for host, page, text in zip(*(part.column(c).to_pylist() for c in ("host", "page", "html"))):
                blocks = read_blocks(text)
                tokens, _ = outside_tokens(blocks, stream_zones(blocks))
                out[0] += [host] * len(tokens)
                out[1] += [page] * len(tokens)
                out[2] += range(len(tokens))
                out[3] += suffixes(tokens, depth)
                out[4] += [any(zone == "open" for zone, _ in blocks)] * len(tokens)
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(out, _SUFFIX)], schema=_SUFFIX)

    return emit


def host_suffix_array(suffix_rows: DataFrame, least: int) -> DataFrame:
    """``host, begins, suffix, depth``: sorted suffixes that share ``least`` tokens or more
    with another page of their host.

    Suffixes that begin alike (``begins``) lie in one partition, so a partition's order is
    the host's order as far as shared beginnings go. It is walked both ways, each as a stream.
    """
    merged = stored(
        suffix_rows.filter(F.octet_length("suffix") >= least * TOKEN)
        .groupBy("host", "suffix")
        .agg(F.min("page").alias("low"), F.max("page").alias("high"))
        .withColumn("begins", _begins(least))
    )
    schema = pa.schema([("host", pa.int64()), ("begins", pa.int64()), ("suffix", pa.binary()), ("depth", pa.int32())])

    def walk(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, near = None, Neighbours()
        for part in parts:
            columns = [part.column(c).to_pylist() for c in ("host", "begins", "suffix", "low", "high")]
            kept = []
            for host, begins, *row in zip(*columns):
                if begins != key:
                    key, near = begins, Neighbours()
                depth = near.step(*row)
                if depth >= least:
                    kept.append((host, begins, row[0], depth))
            arrays = [pa.array(c, f.type) for c, f in zip(list(zip(*kept)) or [[]] * 4, schema)]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    ways = [
        merged.repartition("begins")
        .sortWithinPartitions("begins", order)
        .mapInArrow(walk, "host long, begins long, suffix binary, depth int")
        for order in (F.asc("suffix"), F.desc("suffix"))
    ]
    return ways[0].unionByName(ways[1]).groupBy("host", "begins", "suffix").agg(F.max("depth").alias("depth"))


def _begins(least: int) -> Column:
    return F.xxhash64("host", F.substring("suffix", 1, least * TOKEN))


def widely_held(rows: DataFrame, what: str, sizes: DataFrame, share: float, fewest: int) -> DataFrame:
    """``host`` and ``what``: what at least ``share`` of a host's distinct pages have, and ``fewest`` of them.

    ``rows``: host, page, ``what``. ``sizes``: host and its number of pages. Each
    page counts once; a host's pages are counted ahead of any join.
    """
    counts = rows.select("host", "page", what).distinct().groupBy("host", what).agg(F.count("*").alias("n"))
    enough = (F.col("n") >= fewest) & (F.col("n") >= F.col("pages") * share)
    return counts.filter(F.col("n") >= fewest).join(sizes, "host").filter(enough).select("host", what)


def block_hash(text: str) -> int:
    """What tells blocks apart; their exact text is compared nowhere else."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _block_rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the distinct blocks of each page's article."""
    for part in parts:
        out: list[list] = [[], [], []]
        for host, page, text in zip(*(part.column(c).to_pylist() for c in ("host", "page", "html"))):
            found = {block_hash(t) for zone, t in read_blocks(text) if zone == "article"}
            out[0] += [host] * len(found)
            out[1] += [page] * len(found)
            out[2] += found
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["host", "page", "block"])


def main_text(blocks: list[Block], shared: list[tuple[int, int]] = (), wide: set[int] = frozenset()) -> str:
    """The article's blocks but those that are ``wide``, and the unique runs of open text.

    The open runs stay only where they outweigh the article: repetition is
    cut before the article's claim to speak for the page is judged.
    """
    tokens, block_of = outside_tokens(blocks, stream_zones(blocks))
    gone = np.zeros(len(tokens), bool)
    for position, depth in shared:
        gone[position : position + depth] = True
    kept: dict[int, list[str]] = {}
    for token, block, out in zip(tokens, block_of, gone):
        if not out and blocks[block][0] != "chrome":
            kept.setdefault(block, []).append(token)
    texts = {block: " ".join(words) for block, words in kept.items()}
    speaks = has_article(blocks, sum(map(len, texts.values())))
    for i, (zone, text) in enumerate(blocks):
        if zone == "article" and not (wide and block_hash(text) in wide):
            texts[i] = text
    return "\n".join(t for i, t in sorted(texts.items()) if not speaks or blocks[i][0] == "article")


def extract(
    pages: DataFrame,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    least: int = 6,
    long: int = 24,
    share: float = 0.5,
    fewest: int = 3,
) -> DataFrame:
    """The main text of every page, from its whole source.

    Returns ``id_column``, ``url_column``, ``text`` (blocks joined by line
    ends; empty if there is none) and ``n_chars``, a row per input row. A run of
    ``long`` tokens that another page of the host has outside its article is
    boilerplate; so are ``least`` tokens that ``share`` of the host's pages have
    there, and ``fewest`` of them, and so is a block of articles that as many have.

    A null page has an empty text. A null or odd url belongs to one nameless
    host. Null and repeated ids are kept; equal sources of one host count as
    one page, so mirrored pages do not make each other boilerplate. An empty
    table gives an empty result. Other columns are not looked at.
    """
    host = F.lower(F.regexp_extract(F.coalesce(url_column, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    read = pages.select(
        F.col(id_column).alias("id"),
        F.col(url_column).alias("url"),
        F.coalesce(html_column, F.lit("")).alias("html"),
        F.xxhash64(host).alias("host"),
    ).withColumn("page", F.xxhash64("html"))
    stream = read.select("host", "page", "html")
    # Equal pages are one; a host's pages are counted per task first.
    sizes = stored(stream.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("pages")))
    everywhere = stored(stream.mapInArrow(_suffix_rows(long), SUFFIX))
    grams = everywhere.filter(F.octet_length("suffix") >= least * TOKEN).withColumn("begins", _begins(least))
    wide = stored(widely_held(grams, "begins", sizes, share, fewest).withColumn("wide", F.lit(True)))
    found = host_suffix_array(everywhere, least).join(wide, ["host", "begins"], "left")
    reach = F.when(F.col("depth") >= long, F.col("depth")).when(F.col("wide"), F.lit(least))
    repeated = stored(found.withColumn("depth", reach).filter("depth IS NOT NULL").select("host", "suffix", "depth"))
    covered = stored(
        everywhere.filter("loose")
        .join(repeated, ["host", "suffix"])
        .select("host", "page", "position", "depth")
        .distinct()
        .groupBy("host", "page")
        .agg(F.collect_list(F.struct("position", "depth")).alias("shared"))
    )
    blocks = stream.mapInArrow(_block_rows, "host long, page long, block long")
    wide_blocks = stored(widely_held(blocks, "block", sizes, share, fewest).groupBy("host").agg(F.collect_list("block").alias("blocks")))
    id_type, url_type = (read.schema[c].dataType.simpleString() for c in ("id", "url"))

    def finish(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [
                main_text(
                    read_blocks(page.as_py()),
                    [(s["position"], s["depth"]) for s in shared.as_py() or ()],
                    set(blocks.as_py() or ()),
                )
                for page, shared, blocks in zip(part.column("html"), part.column("shared"), part.column("blocks"))
            ]
            lengths = pa.array([len(t) for t in texts], pa.int64())
            columns = [part.column("id"), part.column("url"), pa.array(texts, pa.string()), lengths]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "url", "text", "n_chars"])

    return (
        # The hosts first: both sides as written, so that the join can split a hot host.
        read.join(wide_blocks, "host", "left")
        .join(covered, ["host", "page"], "left")
        .select("id", "url", "html", "shared", "blocks")
        .mapInArrow(finish, f"id {id_type}, url {url_type}, text string, n_chars long")
        .withColumnsRenamed({"id": id_column, "url": url_column})
    )

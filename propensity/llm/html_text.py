"""Main text of HTML pages: page structure plus a host-wide suffix table.

1. Parsing (one pass, any markup): a page becomes blocks of text in page order,
   each *kept* (inside the page's article container), *dropped* (menus, headers,
   footers, sidebars, notices, adverts, forms, reader comments) or *open*
   (neither: pages or parts without semantic markup, and parts whose class only
   resembles that of a menu, notice or advert).
2. Host suffix array: the token streams of all blocks outside articles are
   concatenated per page; every stream position is a suffix.  Only suffixes
   that agree in their first ``RUN`` tokens can share a long substring, so the
   array is kept as a Spark table grouped by (host, first RUN tokens): a group
   is the array interval with common prefix RUN, found by partial aggregation
   of the smallest and largest page in it, whatever a host's share of all
   pages.  A group spanning two pages is a repeated long substring; a run
   longer than RUN is the union of consecutive such positions.
3. Open blocks lose the tokens that repeated runs cover; unique runs stay.

4. Kept blocks stand in the suffix array too.  A run that begins a kept block in
   ``MIN_ARTICLES`` different articles or more and a tenth of all articles of the
   host is common; an article of which less than ``OWN_SHARE`` stands in blocks
   without common beginning is a copy of others and does not count.  In the other
   articles every suffix of the blocks with common beginning is grouped likewise, and
   blocks leave that repeated runs cover whole, with short neighbours so covered.  (A
   block that leaves, or the first of several, begins with a common run: text that
   begins with none need not be grouped further.)

Copied articles, near copies and passages that few articles of a host share are
main text all the same; so is a kept block that repeated runs cover in part.

Defined cases: NULL or empty html gives an empty text; a page without url is a
host of its own; broken markup (missing end tags, cut pages) is read to the
end; repeated rows are pages of their own but do not count as distinct pages
of one another when page and html are equal; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from propensity.llm.common import bounded_broadcast, staged

RUN = 10
MIN_ARTICLES, HOST_SHARE = 3, 0.1    # a run of kept blocks in fewer articles is no template
OWN_SHARE = 1 / 3                    # an article with less text of its own is a copy of others
KEEP, DROP, OPEN = 0, 1, 2
NO, YES, INNER = 0, 1, 2             # doubt: none, doubtful, container in a doubtful wrapper

# Element and attribute names of HTML.
_RAW = ("script", "style", "noscript", "template", "svg", "iframe", "textarea", "title")
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
         "source", "track", "wbr"}
_BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog",
          "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1",
          "h2", "h3", "h4", "h5", "h6", "head", "header", "hgroup", "hr", "html", "li", "main",
          "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "tbody", "td",
          "tfoot", "th", "thead", "tr", "ul"}
_SKIP_TAGS = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "button", "select",
              "option", "datalist", "search", "fieldset", "label", "input"}
_SKIP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog",
               "alert", "alertdialog", "menu", "menubar", "toolbar", "tablist"}
_SKIP_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "banner",
               "breadcrumb", "breadcrumbs", "comment", "comments", "commentlist", "consent",
               "cookie", "cookies", "copyright", "disqus", "footer", "gdpr", "menu", "modal", "nav",
               "navbar", "navigation", "newsletter", "notice", "notices", "notification", "overlay",
               "pager", "pagination", "popup", "promo", "promotion", "recommended", "related",
               "reply", "replies", "respond", "share", "sharing", "sidebar", "signup", "skip",
               "social", "sponsor", "sponsored", "subscribe", "toolbar", "topbar", "widget"}
_AD_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense"}
_BARRIERS = ("article", "main", "body")     # end tags of inline elements do not reach beyond
_ENDED_BY_NEXT = {"p", "li", "dt", "dd", "tr", "td", "th"}
_HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
_TEXT = {"p", "blockquote", "pre", "dd", "dt", "td", "th", "figcaption", "summary", "address"}
_HEADER_NAMES = {"header", "masthead"}
_CONTENT_NAMES = {"article", "articlebody", "content", "entry", "main", "post", "story"}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\s+|/|[^\s\"'>=/]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*)(?:>|\Z)",
                    re.DOTALL)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'=<>`]+)))?")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.IGNORECASE) for tag in _RAW}
_SPLIT = re.compile(r"[\s_-]+|(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")


def _unseen(found):
    return ("hidden" in found or found.get("aria-hidden", "").lower() == "true"
            or "display:none" in found.get("style", "").replace(" ", "").lower())


def _role(tag, attributes, inside):
    """(skipped, doubtful, container level) that an element adds.

    A whole class or id decides for wrappers; part of a compound name
    (``has-sidebar``) or the name of a paragraph only raises a doubt."""
    found = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        found.setdefault(name.lower(), html.unescape(a or b or c))
    role = found.get("role", "").strip().lower()
    level = 3 if tag == "article" or found.get("itemprop", "").lower() == "articlebody" else \
        2 if tag == "main" or role == "main" else 0
    if level and not found.keys() & {"class", "id"}:
        return False, False, level
    tokens = {t.lower() for key in ("class", "id") if key == "class" or tag not in _HEADINGS
              and tag in _BLOCK for t in found.get(key, "").split()}
    parts = {p.lower() for key in ("class", "id") for p in _SPLIT.split(found.get(key, "")) if p}
    if tag in ("html", "body"):
        return False, False, 0
    skipped = (tag in _SKIP_TAGS or role in _SKIP_ROLES or bool(tokens & _AD_NAMES)
               or (not inside and (tag == "header" or _unseen(found))))
    doubt = False
    if tag in _BLOCK and tag not in _HEADINGS:
        names = _SKIP_NAMES if inside else _SKIP_NAMES | _HEADER_NAMES
        if tag not in _TEXT:
            skipped = skipped or bool(tokens & names)
        doubt = bool(tokens & names) or bool(parts & names)
    if level and parts & _CONTENT_NAMES:
        skipped = doubt = False
    return skipped, doubt, level or (1 if parts & _CONTENT_NAMES and not (skipped or doubt) else 0)


def parse(page: str | None) -> list[tuple[str, int]]:
    """[(block text, KEEP | DROP | OPEN)] in page order; time in proportion to the page:
    the places of open elements are kept by tag, so no tag walks the open stack."""
    page = page or ""
    blocks, pieces = [], []
    stack = []                       # (tag, state) of open elements
    places, blocks_at = {}, []       # stack indexes of open elements by tag, of open blocks
    outside = (False, NO, 0)         # skipped, doubt, container level
    state, at, end = outside, 0, len(page)

    def flush():
        if pieces:
            text = _SPACE.sub(" ", "".join(pieces)).strip()
            pieces.clear()
            if text:
                blocks.append((text, *state))

    def close(index):
        nonlocal state
        for gone, _ in reversed(stack[index:]):
            places[gone].pop()
            if gone in _BLOCK:
                blocks_at.pop()
        del stack[index:]
        state = stack[-1][1] if stack else outside

    while at < end:
        start = page.find("<", at)
        if start < 0:
            start = end
        if start > at:
            pieces.append(html.unescape(page[at:start]))
        if start == end:
            break
        token = _TOKEN.match(page, start)
        if token is None:            # a lone "<" is text
            pieces.append("<")
            at = start + 1
            continue
        at = token.end()
        if token[2] is None:         # comment, doctype or section
            continue
        tag = token[2].lower()
        if tag in _RAW_END and not token[1]:
            done = _RAW_END[tag].search(page, at)
            at = done.end() if done else end
            continue
        if tag == "br":
            pieces.append(" ")
            continue
        if tag in _BLOCK:
            flush()
        if token[1]:
            i = places[tag][-1] if places.get(tag) else -1
            barrier = -1 if tag in _BLOCK else max((places[t][-1] for t in _BARRIERS
                                                    if places.get(t)), default=-1)
            if i >= 0 and i >= barrier:
                if any(x[1] != state for x in stack[i:]) or i and stack[i - 1][1] != state:
                    flush()
                close(i)
            continue
        if tag in _VOID or token[3].endswith("/") and tag not in _BLOCK:
            continue
        # A paragraph or list item ends where a block or the next item begins.
        if tag in _BLOCK and blocks_at:
            last = stack[blocks_at[-1]][0]
            if last == "p" or last == tag and tag in _ENDED_BY_NEXT:
                close(blocks_at[-1])
        skip, doubt, add = _role(tag, token[3], state[2] > 0)
        now = YES if doubt else state[1]
        if add and now:              # a container of its own inside a doubtful wrapper
            now = INNER
        following = (state[0] or skip, now, max(state[2], add))
        if following != state:
            flush()
        state = following
        places.setdefault(tag, []).append(len(stack))
        if tag in _BLOCK:
            blocks_at.append(len(stack))
        stack.append((tag, state))
    flush()
    return _judged(blocks)


def _judged(blocks):
    """KEEP: <article> and <main>, else the highest container there is.  OPEN:
    doubtful parts and lesser containers, and pages without any container."""
    clean = max((lv for _, skip, doubt, lv in blocks if not skip and doubt == NO), default=0)
    best = max((lv for _, skip, doubt, lv in blocks if not skip and doubt != YES), default=0)

    def kind(skip, doubt, lv):
        if skip or best and not lv:
            return DROP
        if doubt == NO:
            return KEEP if lv >= 2 or lv and lv == best else OPEN
        return KEEP if doubt == INNER and lv > clean else OPEN
    return [(text, kind(*rest)) for text, *rest in blocks]


def host_of(url: str | None) -> str | None:
    found = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", url or "")
    return found[1].lower() if found else None


def suffix_heads(tokens: list[str], run: int = RUN) -> list[int]:
    """Hash of the first ``run`` tokens of every suffix that has as many."""
    joined = [xxhash.xxh64_intdigest("\x1f".join(tokens[i:i + run])) - (1 << 63)
              for i in range(len(tokens) - run + 1)]
    return joined


def native_hash(text: str) -> int:
    """What Spark's ``xxhash64`` gives for the string."""
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def block_starts(blocks: list[list[str]]) -> list[int]:
    """Place of each block's first token, and the number of all tokens."""
    starts = [0]
    for tokens in blocks:
        starts.append(starts[-1] + len(tokens))
    return starts


def block_heads(blocks: list[list[str]], run: int = RUN) -> list[dict]:
    """The suffixes of the kept text that begin with a block: its number, the hash of
    the first ``run`` tokens (beyond the block, if it is shorter) and its tokens."""
    stream, starts = [t for tokens in blocks for t in tokens], block_starts(blocks)
    return [{"block": i, "head": suffix_heads(stream[at:at + run], run)[0], "size": len(tokens)}
            for i, (at, tokens) in enumerate(zip(starts, blocks)) if at + run <= len(stream)]


def leaving_blocks(blocks: list[list[str]], covered: set[int], run: int = RUN) -> set[int]:
    """Numbers of the blocks that template runs (starting at ``covered``) cover whole:
    single ones or neighbours, by runs that reach into no block that stays.  Neighbours
    that are all shorter than a run stay (titles that the opening repeats)."""
    starts = block_starts(blocks)
    ends, gone = {at: i for i, at in enumerate(starts[1:])}, set()
    for i, at in enumerate(starts[:-1]):
        if i in gone or at not in covered:
            continue
        reach, last, p = at + run, None, at
        while p <= reach:
            if p in covered:
                reach = p + run
                last = ends.get(reach, last)
            p += 1
        if last is not None and any(len(tokens) >= run for tokens in blocks[i:last + 1]):
            gone.update(range(i, last + 1))
    return gone


_HEADS = pa.list_(pa.struct([("block", pa.int32()), ("head", pa.int64()), ("size", pa.int32())]))
_PLACES = pa.list_(pa.struct([("pos", pa.int32()), ("head", pa.int64())]))
_PARSED = pa.list_(pa.struct([("text", pa.string()), ("kind", pa.int32())]))


def _parse_batches(run):
    def go(batches):
        for batch in batches:
            hosts, texts, suffixes, copies, articles, heads, sizes = [], [], [], [], [], [], []
            for key, url, page in zip(*(batch.column(c).to_pylist()
                                        for c in ("page_id", "url", "html"))):
                blocks = parse(page)
                outside = [t for text, kind in blocks if kind != KEEP for t in text.split(" ")]
                open_ = any(kind == OPEN for _, kind in blocks)
                texts.append([{"text": t, "kind": k} for t, k in blocks if k != DROP]
                             if not open_ else [{"text": t, "kind": k} for t, k in blocks])
                suffixes.append(suffix_heads(outside, run))
                kept = [t for t, kind in blocks if kind == KEEP]
                articles.append(native_hash("\n".join(kept)) if kept else None)
                kept = [t.split(" ") for t in kept]
                heads.append(block_heads(kept, run))
                sizes.append(sum(map(len, kept)))
                copies.append(xxhash.xxh64_intdigest(f"{key}\x1f{page}") - (1 << 63))
                hosts.append(host_of(url) or f"\x1f{key}")
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(hosts, pa.string()),
                 pa.array(copies, pa.int64()), pa.array(texts, _PARSED),
                 pa.array(suffixes, pa.list_(pa.int64())), pa.array(articles, pa.int64()),
                 pa.array(heads, _HEADS), pa.array(sizes, pa.int32())],
                names=["page_id", "url", "host", "copy", "blocks", "suffixes", "article", "heads",
                       "kept_size"])
    return go


def _kept(blocks):
    return [b["text"].split(" ") for b in blocks if b["kind"] == KEEP]


def _suffix_batches(run):
    """All suffixes that begin in the kept blocks numbered ``common``."""
    def go(batches):
        for batch in batches:
            places = []
            for blocks, common in zip(batch.column("blocks").to_pylist(),
                                      batch.column("common").to_pylist()):
                blocks = _kept(blocks)
                stream, starts = [t for tokens in blocks for t in tokens], block_starts(blocks)
                places.append([{"pos": starts[i] + k, "head": head} for i in common
                               for k, head in enumerate(suffix_heads(
                                   stream[starts[i]:starts[i + 1] + run - 1], run))])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("uid", "host", "article")), pa.array(places, _PLACES)],
                names=["uid", "host", "article", "places"])
    return go


def _common(places: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, head) of the runs in enough different articles of the host."""
    return (places.select("host", "article", "head").distinct()
            .groupBy("host", "head").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_ARTICLES)
            .join(hosts, "host").where(F.col("n") >= HOST_SHARE * F.col("articles"))
            .select("host", "head"))


def templates(parsed: DataFrame, run: int = RUN) -> DataFrame:
    """(uid, covered): places in a page's kept text where template runs of its host start.

    Counted in steps, each with map-side combine: equal articles, then runs."""
    kept = parsed.where("article is not null")
    hosts = kept.select("host", "article").distinct().groupBy("host").agg(F.count("*").alias("articles"))
    heads = kept.select("uid", "host", "article", "kept_size", F.explode("heads").alias("h")).select(
        "uid", "host", "article", "kept_size", "h.*")
    first, _ = staged(_common(heads, hosts), "page-beginnings")
    common, _ = staged(
        heads.join(bounded_broadcast(first), ["host", "head"]).groupBy("uid", "kept_size")
        .agg(F.collect_set("block").alias("common"), F.sum("size").alias("shared"))   # a page's blocks
        .where(F.col("kept_size") - F.col("shared") >= OWN_SHARE * F.col("kept_size"))
        .select("uid", "common"), "page-candidates")
    places, _ = staged(
        kept.select("uid", "host", "article", "blocks").join(bounded_broadcast(common), "uid")
        .mapInArrow(_suffix_batches(run), "uid long, host string, article long, "
                    "places array<struct<pos:int,head:long>>"), "page-suffixes")
    places = places.select("uid", "host", "article", F.explode("places").alias("p")).select(
        "uid", "host", "article", "p.*")
    return (places.join(_common(places, hosts), ["host", "head"])
            .groupBy("uid").agg(F.collect_list("pos").alias("covered")))   # at most a page's length


def unique_runs(blocks, starts, templated=(), run: int = RUN) -> str:
    """The page text once the tokens of repeated runs leave the open blocks, and blocks
    that template runs (starting at ``templated``) cover leave the kept ones."""
    covered = {p for s in starts for p in range(s, s + run)}
    gone = leaving_blocks([text.split(" ") for text, kind in blocks if kind == KEEP],
                          set(templated), run) if templated else ()
    out, at, number = [], 0, 0
    for text, kind in blocks:
        if kind == KEEP:
            if number not in gone:
                out.append(text)
            number += 1
            continue
        tokens = text.split(" ")
        if kind == OPEN:
            left = [t for i, t in enumerate(tokens, at) if i not in covered]
            if left:
                out.append(" ".join(left))
        at += len(tokens)
    return "\n".join(out)


def _assemble_batches(run):
    def go(batches):
        for batch in batches:
            texts = [unique_runs([(b["text"], b["kind"]) for b in blocks], starts or (), covered or (), run)
                     for blocks, starts, covered in zip(*(batch.column(c).to_pylist() for c in
                                                          ("blocks", "starts", "covered")))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"])
    return go


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", page: str = "html",
            run: int = RUN) -> DataFrame:
    """page_id, url, text (blocks joined by newline), n_chars."""
    rows = pages.select(F.col(f"`{key}`").alias("page_id"), F.col(f"`{url}`").alias("url"),
                        F.col(f"`{page}`").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    parsed, _ = staged(rows.mapInArrow(
        _parse_batches(run), f"page_id {kind}, url string, host string, copy long, "
        "blocks array<struct<text:string,kind:int>>, suffixes array<long>, article long, "
        "heads array<struct<block:int,head:long,size:int>>, kept_size int")
        .withColumn("uid", F.monotonically_increasing_id()), "page-blocks")
    suffixes = parsed.select("uid", "host", "copy", F.posexplode("suffixes").alias("pos", "head"),
                             F.exists("blocks", lambda b: b["kind"] == OPEN).alias("open"))
    repeated = (suffixes.groupBy("host", "head")
                .agg(F.min("copy").alias("low"), F.max("copy").alias("high"))
                .where("low <> high").select("host", "head"))
    starts = (suffixes.where("open").select("uid", "host", "head", "pos")
              .join(repeated, ["host", "head"])
              .groupBy("uid").agg(F.collect_list("pos").alias("starts")))   # at most a page's length
    covered, _ = staged(templates(parsed, run), "page-templates")
    parsed = parsed.join(bounded_broadcast(covered), "uid", "left")
    decided = F.exists("blocks", lambda b: b["kind"] == OPEN) | F.col("covered").isNotNull()
    shape = f"page_id {kind}, url string, text string"
    judged = (parsed.where(decided).select("uid", "page_id", "url", "blocks", "covered")
              .join(starts, "uid", "left").select("page_id", "url", "blocks", "starts", "covered")
              .mapInArrow(_assemble_batches(run), shape))
    plain = parsed.where(~decided).select("page_id", "url", F.array_join(
        F.transform("blocks", lambda b: b["text"]), "\n").alias("text"))
    return plain.union(judged).withColumn("n_chars", F.length("text").cast("long"))

"""Secret scan with corpus-wide ownership frequency.

Candidates of a text are the base patterns (assignments, access ids, hex runs)
plus long mixed tokens that no base span touches.  Each candidate's value is
hashed and the hashes are aggregated over the whole corpus: in how many
distinct repositories, and with how many distinct owners, does the value
occur?  A value is a widely copied example if very many repositories hold it,
whoever owns them, or if many owners share it in more than a few repositories;
any other one is live-looking.  Base spans are always reported, and masked
whatever their length or entropy unless they are examples.  A long mixed token
becomes a span only if it is live-looking and random: digits among letters of
both cases, or a long unbroken run of one case, and no path, slug or word.

Aggregation is two-level (value, owner) then (value), each with map-side
combine, so a value found in a third of all rows is never gathered; verdicts
return by an unhinted join, whose skewed keys adaptive execution splits.

Defined cases: NULL or empty text has no span; a NULL owner or repository is
one value of its own; repeated rows are separate rows of the result but one
repository; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from propensity.llm.common import bounded_broadcast, row_fingerprint, staged

# The base kinds in the order in which ties are listed.
KINDS = ("assign", "access", "hex", "mixed")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIXED = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}")   # with a digit
_PART = re.compile(r"[A-Za-z0-9]+")
# A number, a word, an acronym or joined words, each with a short number behind.
_WORD = re.compile(r"[A-Za-z]?[0-9]+|(?:[A-Z]?[a-z]+|[A-Z]+)(?:[A-Z][a-z]+)*[A-Z]*[0-9]{0,4}")
# The humps of a joined name, and its numbers.
_HUMP = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_VOWEL = re.compile(r"[aeiouyAEIOUY]|^[A-Z]+$")     # words have vowels, acronyms need none
NAME_HUMP = 3           # letters a hump of a name has on the mean; those of a key have two or so
_CHANGE = re.compile(r"(?<=[0-9])[A-Za-z]|(?<=[A-Za-z])[0-9]")
NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")

MAX_OWNERS = 2          # more distinct owners than this share an example ...
FEW_REPOS = 4           # ... unless no more repositories than this hold it
MAX_REPOS = 8           # more distinct repositories than this: an example, whoever owns them
MIN_ENTROPY = 3.0       # bits a character of a live-looking mixed token
MIN_RUN, MIN_CHANGES = 24, 6    # one-case runs: length, and changes between letter and digit
MASK = "[SECRET]"


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def is_name(part: str) -> bool:
    """Words joined by case with short numbers between, as identifiers are."""
    humps = _HUMP.findall(part)
    letters = [h for h in humps if not h[0].isdigit()]
    return (bool(letters) and sum(map(len, letters)) >= NAME_HUMP * len(letters)
            and sum(len(h) < 2 for h in letters) * 8 <= len(letters)
            and sum(len(h) > 1 and not _VOWEL.search(h) for h in letters) * 4 <= len(letters)
            and len(humps) - len(letters) <= len(letters)
            and all(len(h) <= 4 for h in humps if h[0].isdigit()))


def is_random(value: str) -> bool:
    """Whether a mixed token looks like a key rather than a path, slug or word."""
    parts = _PART.findall(value)
    odd = [p for p in parts if not _WORD.fullmatch(p) and not is_name(p)]
    joined = "".join(odd)
    if 2 * len(joined) < sum(map(len, parts)) or not any(c.isdigit() for c in joined) \
            or entropy(value) < MIN_ENTROPY:
        return False
    return (joined.lower() != joined != joined.upper()
            or any(len(p) >= MIN_RUN and len(_CHANGE.findall(p)) >= MIN_CHANGES for p in odd))


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind index, end, value) of the base patterns, by start and kind."""
    found, low = [], text.lower()
    if any(name in low for name in NAMES):      # plain search first: most texts name none
        found = [(m.start(), 0, m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end(), m[0]) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str | None):
    """Base spans, and the random mixed tokens that touch none of them."""
    text = text or ""
    base = base_spans(text)
    extra, at, reach = [], 0, 0
    for m in MIXED.finditer(text):      # both lists are in order: reach is the end of the base spans before m's
        while at < len(base) and base[at][0] < m.end():
            reach, at = max(reach, base[at][2]), at + 1
        if reach <= m.start() and is_random(m[0]):
            extra.append((m.start(), 3, m.end(), m[0]))
    return base, extra


def listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e, *_ in spans)


_CANDIDATE = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64()),
                        ("hash", pa.int64())])
_SCAN = ("n_assign long, n_access long, n_hex long, base_sha256 string, "
         "found array<struct<start:long, kind:int, end:long, hash:long>>")


def _scan_batches(batches):
    for batch in batches:
        counts, digests, found = ([], [], []), [], []
        for text in batch.column("text"):
            base, extra = candidates(text.as_py())
            for kind, column in enumerate(counts):
                column.append(sum(k == kind for _, k, _, _ in base))
            digests.append(hashlib.sha256(listed(base).encode()).hexdigest())
            found.append([{"start": s, "kind": k, "end": e,
                           "hash": xxhash.xxh64_intdigest(v.encode()) - (1 << 63)}
                          for s, k, e, v in base + extra])
        keep = [batch.column(c) for c in ("key", "owner", "repo")]
        yield pa.RecordBatch.from_arrays(
            [*keep, *(pa.array(c, pa.int64()) for c in counts), pa.array(digests, pa.string()),
             pa.array(found, pa.list_(_CANDIDATE))],
            names=["key", "owner", "repo", "n_assign", "n_access", "n_hex", "base_sha256", "found"])


def ownership(found: DataFrame) -> DataFrame:
    """``found(hash, owner, repo)`` -> hash, owners, repos (distinct counts)."""
    by_repo = found.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one"))
    by_owner = by_repo.groupBy("hash", "owner").agg(F.sum("one").alias("repos"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("owners"),
                                        F.sum("repos").alias("repos"))


def is_example(max_owners: int = MAX_OWNERS, max_repos: int = MAX_REPOS) -> Column:
    return (F.col("repos") > max_repos) | ((F.col("owners") > max_owners)
                                           & (F.col("repos") > FEW_REPOS))


def scan(docs: DataFrame, key: Column, owner: str = "source", repo: Column | None = None,
         text: str = "text", max_owners: int = MAX_OWNERS,
         max_repos: int = MAX_REPOS) -> DataFrame:
    """One row per input row: key, base counts and digest, and ``found``: an
    array of (start, kind, end, owners, repos, live) of every reported span."""
    rows = docs.select(key.alias("key"), F.col(f"`{owner}`").cast("string").alias("owner"),
                       (key if repo is None else repo).alias("repo"),
                       F.col(f"`{text}`").alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    seen, _ = staged(rows.mapInArrow(
        _scan_batches, f"key {kinds['key']}, owner {kinds['owner']}, repo {kinds['repo']}, {_SCAN}")
        .withColumn("row", F.monotonically_increasing_id()), "secret-candidates")
    each = seen.where(F.size("found") > 0).select(
        "row", "owner", "repo", F.explode("found").alias("f")).select("row", "owner", "repo", "f.*")
    judged = (each.join(ownership(each), "hash")
              .withColumn("live", ~is_example(max_owners, max_repos))
              .where((F.col("kind") < 3) | F.col("live"))
              .groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
                  "start", "kind", "end", "owners", "repos", "live"))).alias("found")))
    nothing = F.array().cast("array<struct<start:long,kind:int,end:long,owners:long,repos:long,"
                             "live:boolean>>")
    return (seen.drop("found").join(judged, "row", "left")
            .select("key", "n_assign", "n_access", "n_hex", "base_sha256",
                    F.coalesce("found", nothing).alias("found")))


def span_list(found) -> Column:
    kind = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(found, lambda f: F.concat_ws(
        ":", F.element_at(kind, f["kind"] + 1), f["start"].cast("string"),
        f["end"].cast("string"))), ",")


def _mask(text: str, spans) -> str:
    out, at = [], 0
    for start, end in spans:
        if end > at:
            out += [text[at:max(at, start)], MASK] if start >= at else []
            at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, key: str = "doc_id", owner: str = "source", text: str = "text",
           length: str = "n_chars") -> DataFrame:
    """``docs`` with live-looking values masked in the text (and the length
    column brought up to date); widely copied examples stay as they are."""
    whole = F.struct(F.col(f"`{key}`").alias("id"), row_fingerprint(docs).alias("row"))
    hits = (scan(docs, whole, owner, F.col(f"`{key}`").cast("string"), text)
            .select("key", F.expr("transform(filter(found, f -> f.live), "
                                  "f -> struct(f.start, f.end))").alias("spans"))
            .where(F.size("spans") > 0).dropDuplicates(["key"])
            .select(F.col("key.id").alias("id"), F.col("key.row").alias("row"), "spans"))
    hits, _ = staged(hits, "secret-hits")
    total = hits.agg(F.sum(F.size("spans") + 1)).first()[0] or 0
    hits = bounded_broadcast(hits, total)

    @F.pandas_udf("string")
    def masked(texts, spans):
        return texts.combine(spans, lambda t, s: _mask(t, [(x["start"], x["end"]) for x in s]))

    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                         F.col(f"`{key}`").alias("id_"), row_fingerprint(docs).alias("row_"))
    joined = marked.join(hits, (F.col("row_") == F.col("row"))
                         & F.col("id_").eqNullSafe(F.col("id")), "left")
    clean = joined.where("spans is null").select("doc.*")
    dirty = joined.where("spans is not null").select("doc", masked(F.col(f"doc.`{text}`"), "spans").alias("new_"))
    columns = [F.col("new_").alias(c) if c == text else
               F.length("new_").cast(docs.schema[c].dataType).alias(c) if c == length else
               F.col(f"doc.`{c}`").alias(c) for c in docs.columns]
    return clean.union(dirty.select(*columns))

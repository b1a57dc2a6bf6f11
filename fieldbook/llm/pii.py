"""Operator 7: personal data by patterns, and by contexts that the patterns teach.

The base scan finds e-mail addresses, IP addresses, payment cards and phone numbers.  Those
are the seeds.  Words around seeds, and around other tokens that look like an
identifier, are lexical patterns; patterns and the values seen in them make a graph.  Spark
scores it in ``ROUNDS`` rounds: a pattern is as good as the mean score of its values, a value
as good as its patterns together.  Patterns with a confidence of ``CONFIDENCE`` and
``SUPPORT`` seeds add the identifiers that stand in them.

Identifiers of any other shape (``AB1234567``, ``ext-44871``, a five-digit number) are a kind of their own, ``id``, without a
pattern of the base scan.  Their contexts are scored by the seeds of all four kinds, and their shapes (letters as ``A``, digits as ``9``) are
learned from the instances: a shape counts if at least ``SHAPE`` of all its tokens, and ``SUPPORT`` of them, stand in
learned contexts, so that years, amounts and part numbers that stand anywhere are left alone.  An identifier is one token of 5 to 40
letters, digits and ``. _ / -``, with three digits or more, and five where it has no letter.

Scores are aggregates with partial sums, joins let Spark split a hot pattern, and nothing
but the stored tables grows with the corpus.

Edge cases.  A null or blank text has no spans.  Null ids, repeated rows and other columns do
not matter: rows are told apart by a number of their own.  An empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldbook.llm.storage import Scratch, dealt

ROUNDS = 3
CONFIDENCE = 0.85
SUPPORT = 5
SHAPE = 0.5
# Kinds in the order that breaks ties, and the patterns of the scan.
KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)  # the kind of identifiers that only contexts find
NAMES = (*KINDS, "id")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Groups of digits with what phone and card numbers have between them, as a whole.
_RUN = re.compile(r"(?<![A-Za-z0-9_@])(?:\+|\()?[0-9]++(?:[\x20().-]{1,3}+[0-9]++)++(?![A-Za-z0-9_@])")

_DIGIT = re.compile(r"[0-9]")
_PLAIN = re.compile(r"[A-Za-z0-9._/-]{5,40}")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGE = ".,;:!?'\"()[]{}<>|*$&%#="
_SPAN = "struct<start:bigint,kind:int,stop:bigint>"
_SCHEMA = (f"doc_id bigint, digest binary, n array<bigint>, base_sha256 string, base array<{_SPAN}>, "
           "seen array<struct<start:bigint,kind:int,stop:bigint,value:string,seed:boolean,patterns:array<string>>>")

_DIGEST, _FOUND = "_pii_digest", "_pii_found"  # names that no input column has

Span = tuple[int, int, int]  # start, kind number, end


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, 0, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def matches(text: str) -> list[Span]:
    """Base spans of ``text`` by start, then kind."""
    out = list(_emails(text)) if "@" in text else []
    if _DIGIT.search(text):
        if "." in text:
            out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(int(p) <= 255 for p in _parts(m.group()))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = re.sub(r"[\x20-]", "", m.group())
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    out.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(map(str.isdigit, m.group())) <= 15:
                    out.append((m.start(), 3, m.end()))
    return sorted(out)


def _parts(dotted: str) -> list[str]:
    return [p.lstrip("0")[:4] or "0" for p in dotted.split(".")]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{NAMES[k]}:{a}:{b}" for a, k, b in sorted(spans))


def _looks_like(value: str) -> int | None:
    """Kind that a token could be an identifier of."""
    digits = sum("0" <= c <= "9" for c in value)
    if "@" in value[1:-1]:
        return 0
    letters = any(c.isalpha() for c in value)
    if digits >= 6 and not letters:
        if value.count(".") == 3:
            return 1
        if 7 <= digits <= 11 or 12 <= digits <= 19:
            return 2 if digits >= 12 else 3
    return OTHER if digits >= (3 if letters else 5) and _PLAIN.fullmatch(value) else None


def _contexts(text: str, words: list[tuple[int, int]], first: int, last: int) -> list[str]:
    """Lexical patterns of the words ``first .. last``: the words left of them, and those on both sides."""
    def word(k):
        return text[slice(*words[k])].lower().strip(_EDGE) if 0 <= k < len(words) else "^"
    one, two, right = word(first - 1), word(first - 2), word(last + 1)
    return [f"l {one}", f"ll {two} {one}", f"lr {one} {right}"]


def observe(text: str, base: list[Span]) -> list[dict]:
    """Seeds and other identifier-like tokens of ``text`` with their patterns."""
    if not base and not _DIGIT.search(text) and "@" not in text:
        return []
    words = [m.span() for m in _WORD.finditer(text)]
    starts = [w[0] for w in words]
    out = []
    from bisect import bisect_left, bisect_right

    def add(start, kind, stop, seed):
        first, last = bisect_right(starts, start) - 1, bisect_right(starts, stop - 1) - 1
        out.append({"start": start, "kind": kind, "stop": stop, "value": text[start:stop], "seed": seed,
                    "patterns": _contexts(text, words, first, last)})
    for a, k, b in base:
        add(a, k, b, True)
    taken = sorted((a, b) for a, _, b in base)

    begins, upto = [a for a, _ in taken], list(accumulate((b for _, b in taken), max))
    for m in _RUN.finditer(text):
        kind = _looks_like(m.group())
        before = bisect_left(begins, m.end())  # seeds that start before the run ends
        if kind in (2, 3) and "\x20" in m.group() and not (before and upto[before - 1] > m.start()):
            add(m.start(), kind, m.end(), False)
    at = 0
    for lo, hi in words:
        while at < len(taken) and taken[at][1] <= lo:
            at += 1
        if at < len(taken) and taken[at][0] < hi:
            continue
        raw = text[lo:hi]
        value = raw.strip(_EDGE)
        kind = _looks_like(value) if value else None
        if kind is not None:
            start = lo + raw.index(value)
            add(start, kind, start + len(value), False)
    return out


def _observe_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64())])
    seen = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("stop", pa.int64()), ("value", pa.string()),
                      ("seed", pa.bool_()), ("patterns", pa.list_(pa.string()))])
    for batch in batches:
        digests, counts, shas, bases, views = [], [], [], [], []
        for value in batch.column(1):
            text = value.as_py() or ""
            base = matches(text)
            digests.append(text_digest(text))
            counts.append([sum(k == j for _, k, _ in base) for j in range(len(KINDS))])
            shas.append(hashlib.sha256(joined(base).encode()).hexdigest())
            bases.append([{"start": a, "kind": k, "stop": b} for a, k, b in base])
            views.append(observe(text, base))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(digests, pa.binary()), pa.array(counts, pa.list_(pa.int64())), pa.array(shas, pa.string()),
             pa.array(bases, pa.list_(span)), pa.array(views, pa.list_(seen))],
            names=["doc_id", "digest", "n", "base_sha256", "base", "seen"])


def text_digest(text: str) -> bytes:
    return hashlib.sha256(text.encode()).digest()


def score_patterns(edges: DataFrame, scratch: Scratch, rounds: int = ROUNDS) -> DataFrame:
    """(kind, pattern, confidence, seeds) from edges (kind, pattern, value, seed)."""
    edges = scratch.store(edges.groupBy("kind", "pattern", "value").agg(F.max("seed").alias("seed")), "edges")
    values = edges.groupBy("kind", "value").agg(F.max(F.col("seed").cast("double")).alias("score"))
    for k in range(rounds):
        values = scratch.store(values, f"values-{k}")
        patterns = scratch.store(
            edges.join(values, ["kind", "value"]).groupBy("kind", "pattern")
            .agg((F.sum("score") / (F.count(F.lit(1)) + 0.5)).alias("confidence"), F.sum(F.col("seed").cast("bigint")).alias("seeds")),
            f"patterns-{k}")
        together = F.lit(1.0) - F.exp(F.sum(F.log(F.lit(1.0) - F.least("confidence", F.lit(0.999)))))
        values = (edges.join(patterns.where(F.col("seeds") >= SUPPORT), ["kind", "pattern"]).groupBy("kind", "value")
                  .agg(F.greatest(F.max(F.col("seed").cast("double")), together).alias("score")))
        values = edges.select("kind", "value", "seed").distinct().join(values, ["kind", "value"], "left").groupBy("kind", "value").agg(
            F.max(F.coalesce("score", F.col("seed").cast("double"))).alias("score"))
    return patterns


def _shape(value: str) -> Column:
    return F.regexp_replace(F.regexp_replace(value, "[A-Za-z]", "A"), "[0-9]", "9")


def learned_shapes(views: DataFrame, hits: DataFrame) -> DataFrame:
    """Shapes of which enough tokens stand in learned contexts, from all tokens (kind, value) and those in contexts (shape)."""
    # The shapes are counted before they meet, so a shape that a third of all tokens have is one row.
    inside = hits.groupBy("shape").agg(F.count(F.lit(1)).alias("inside")).where(F.col("inside") >= SUPPORT)
    everywhere = views.where(F.col("kind") == OTHER).groupBy(_shape("value").alias("shape")).agg(F.count(F.lit(1)).alias("all"))
    return inside.join(everywhere, "shape").where(F.col("inside") >= SHAPE * F.col("all")).select("shape")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Personal data of every document (doc_id, text).

    Returns doc_id, digest (of the text), n_email, n_ip, n_card, n_phone, base_sha256, spans, and
    ``found``: all spans as an array of (start, kind number, stop).
    """
    scratch = Scratch(docs.sparkSession, "pii")
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    rows = scratch.store(ids.mapInArrow(_observe_batches, _SCHEMA).withColumn("row", F.monotonically_increasing_id()), "rows")
    views = rows.where("size(seen) > 0").select("row", F.explode("seen").alias("s")).select("row", "s.*")
    # Every token is seen under its own kind; those of all kinds together tell in which contexts other identifiers stand.
    kinds = F.array_distinct(F.array("kind", F.lit(OTHER)))
    graph = views.select(F.explode(kinds).alias("kind"), "patterns", "value", "seed").withColumn("pattern", F.explode("patterns")).drop("patterns")
    good = (score_patterns(graph, scratch)
            .where((F.col("confidence") >= CONFIDENCE) & (F.col("seeds") >= SUPPORT)).select("kind", "pattern"))
    hits = (views.where("not seed").select("row", "start", "kind", "stop", "value", F.explode("patterns").alias("pattern"))
            .join(good, ["kind", "pattern"], "left_semi").select("row", "start", "kind", "stop", _shape("value").alias("shape")).distinct())
    hits = scratch.store(hits, "hits")
    span = F.struct("start", "kind", "stop").alias("span")
    others = hits.where(F.col("kind") == OTHER)
    added = (hits.where(F.col("kind") != OTHER).select("row", span)
             .unionAll(others.join(dealt(learned_shapes(views, others), "shape"), "shape", "left_semi").select("row", span)))
    more = added.groupBy("row").agg(F.collect_list("span").alias("more"))
    names = F.array(*[F.lit(k) for k in NAMES])
    found = F.sort_array(F.concat("base", F.coalesce("more", F.array().cast(f"array<{_SPAN}>"))))
    text = F.array_join(F.transform("found", lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["stop"])), ",")
    return (rows.join(more, "row", "left").withColumn("found", found)
            .select("doc_id", "digest", *[F.get("n", F.lit(j)).alias(f"n_{k}") for j, k in enumerate(KINDS)],
                    "base_sha256", text.alias("spans"), "found"))


def redact(text: str, spans: list) -> str:
    """``text`` with every span replaced by the name of its kind; overlapping spans become one."""
    out, at, spans = [], 0, sorted((s["start"], s["stop"], s["kind"]) for s in spans)
    k = 0
    while k < len(spans):
        start, stop, kind = spans[k]
        k += 1
        while k < len(spans) and spans[k][0] < stop:
            stop = max(stop, spans[k][1])
            k += 1
        out += [text[at:start], f"[{NAMES[kind].upper()}]"]
        at = stop
    return "".join([*out, text[at:]])


def _redact_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, spans = batch.column("text"), batch.column(_FOUND)
        new = [redact(t.as_py(), s.as_py()) if s.is_valid and t.is_valid else t.as_py() for t, s in zip(texts, spans, strict=True)]
        names = [n for n in batch.schema.names if n != _FOUND]
        yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if n == "text" else batch.column(n) for n in names], names=names)


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with its personal data replaced; all columns are kept, other texts stay as they are."""
    found = (find_personal_data(docs.select("doc_id", "text")).where("size(found) > 0")
             .select(F.col("digest").alias(_DIGEST), F.col("found").alias(_FOUND)).dropDuplicates([_DIGEST]))
    marked = (docs.withColumn(_DIGEST, F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)))
              .join(found, _DIGEST, "left").drop(_DIGEST))
    return marked.mapInArrow(_redact_batches, docs.schema)

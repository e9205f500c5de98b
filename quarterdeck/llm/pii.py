"""Personal data by bootstrapped contextual extraction.

The base expressions find the seeds (mail and network addresses, card and phone numbers). Words
around a seed are a lexical pattern: the word before it and the word after it, for each kind. Other
number-like tokens in the same surroundings are instances of the pattern. Spark scores the graph of
patterns and instances in rounds: a pattern's confidence is the mean of its instances' scores, drawn
towards 0 by ``DRAWN`` absent ones; an instance that is no seed scores as its best pattern. Patterns
with ``SEEDS`` different seeds and a confidence of ``SURE`` or more discover their other
instances, as spans of kind ``context``. Base spans always stay.

The scan keeps texts in their tasks; what moves is one row for each seed or candidate, with hashes of
the words. A pattern or an instance is an aggregate that is joined back, never a gathered group.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.common import arrow_map
from quarterdeck.session import written

ROUNDS, DRAWN, SEEDS, SURE = 3, 2.0, 3, 0.6
#: The base expressions. Where a match could only begin later within a run of the same
#: characters, it is kept from beginning there, which changes no result and avoids quadratic work.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")
CONTEXT = "context"
NUMBER, WORD = re.compile(r"[0-9]+"), re.compile(r"[^\W\d_]+")
TRIM, AROUND, LONGEST, DIGITS = "\"'`.,;:!?()[]{}<>|*#$%&=", 40, 64, 4

Span = tuple[int, int]


def emails(text: str) -> list[Span]:
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            free = domain.end()
        at = text.find("@", max(at + 1, free))
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; offsets count code points."""
    ips = [m.span() for m in IP.finditer(text) if all(map(_small, m[0].split(".")))]
    cards = [m.span() for m in CARD.finditer(text)
             if 13 <= len(d := _digits(m[0])) <= 19 and luhn(d)]
    phones = [m.span() for m in PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return [(k, *s) for k, spans in zip(KINDS, (emails(text), ips, cards, phones)) for s in spans]


def candidates(text: str, taken: list[Span]) -> list[Span]:
    """Tokens of at most LONGEST characters with DIGITS digits or more that touch no base span."""
    found, free, taken = [], 0, sorted(taken)
    place = 0
    for run in NUMBER.finditer(text):
        start, end = run.span()
        if start < free:
            continue
        while start > free and end - start <= LONGEST and not text[start - 1].isspace():
            start -= 1
        while end < len(text) and end - start <= LONGEST and not text[end].isspace():
            end += 1
        free = end
        token = text[start:end]
        start += len(token) - len(token.lstrip(TRIM))
        end = start + len(token.strip(TRIM))
        if end - start > LONGEST or len(_digits(text[start:end])) < DIGITS:
            continue
        while place < len(taken) and taken[place][1] <= start:
            place += 1
        if not any(a < end and start < b for a, b in taken[place:place + 4]):
            found.append((start, end))
    return found


def pattern(text: str, start: int, end: int) -> str | None:
    """The words next to a span, at most AROUND characters away; None without both."""
    left = WORD.findall(text[max(0, start - AROUND):start])
    right = WORD.search(text, end, end + AROUND)
    return f"{left[-1].lower()} _ {right[0].lower()}" if left and right else None


def _hash(text: str) -> int:
    value = xxhash.xxh3_64_intdigest(text.encode())
    return value - ((value >> 63) << 64)


SCAN = ("row long, doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
        "base_sha256 string, base string, "
        "met array<struct<pattern:long,instance:long,seed:boolean,start:int,end:int>>")


def _joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(docs: DataFrame) -> DataFrame:
    """Base spans of every text, and its seeds and candidates with their patterns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            out = {name.split()[0]: [] for name in SCAN.split(", ")}
            for doc_id, value in zip(batch["doc_id"].to_pylist(), batch["text"]):
                text = value.as_py() or ""
                spans = base_spans(text)
                met = [(s, e, True) for _, s, e in spans]
                met += [(s, e, False) for s, e in candidates(text, [x[1:] for x in spans])]
                edges = [{"pattern": _hash(p), "instance": _hash(text[s:e]), "seed": seed,
                          "start": s, "end": e}
                         for s, e, seed in met if (p := pattern(text, s, e))]
                base = _joined(spans)
                values = [row, doc_id, *(sum(x[0] == k for x in spans) for k in KINDS),
                          hashlib.sha256(base.encode()).hexdigest(), base, edges]
                for name, v in zip(out, values):
                    out[name].append(v)
                row += 1
            yield out

    return arrow_map(docs.select("doc_id", "text"), run, SCAN)


def sure_patterns(edges: DataFrame) -> DataFrame:
    """The patterns that discover, from distinct edges (pattern, instance, seed)."""
    scores = edges.select("pattern", "instance", "seed",
                          F.col("seed").cast("double").alias("score"))
    confidence = None
    for _ in range(ROUNDS):
        confidence = written(scores.groupBy("pattern").agg(
            (F.sum("score") / (F.count("*") + DRAWN)).alias("confidence"),
            F.sum(F.col("seed").cast("long")).alias("seeds")), "patterns")
        best = (edges.join(confidence, "pattern").groupBy("instance")
                .agg(F.max("confidence").alias("best")))
        scores = edges.join(best, "instance").select(
            "pattern", "instance", "seed",
            F.when(F.col("seed"), F.lit(1.0)).otherwise(F.col("best")).alias("score"))
    return confidence.where((F.col("seeds") >= SEEDS) & (F.col("confidence") >= SURE)).select(
        "pattern")


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the digest of their spans, and all spans by kind (``context``
    last), then start. A null text is empty; repeated rows are rows of their own."""
    found = written(scan(docs), "personal-data")
    met = found.select("row", F.explode("met").alias("m")).select("row", "m.*")
    edges = written(met.groupBy("pattern", "instance").agg(F.max("seed").alias("seed")), "edges")
    new = (met.where(~F.col("seed")).join(sure_patterns(edges), "pattern")
           .groupBy("row").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("new")))
    more = F.transform(F.col("new"), lambda s: F.concat_ws(
        ":", F.lit(CONTEXT), s["start"].cast("string"), s["end"].cast("string")))
    return found.drop("met").join(new, "row", "left").select(
        "doc_id", *[f"n_{k}" for k in KINDS], "base_sha256",
        F.concat_ws(",", F.expr("nullif(base, '')"), F.array_join(more, ",")).alias("spans"))

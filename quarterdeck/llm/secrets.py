"""Secret scans by a trigram inverted index, in DataFrame operations only.

Each rule's regular expression gives a Boolean trigram query (``trigrams.alternatives``). The index
has a posting (trigram, document) for every trigram of these queries that occurs in the lower-cased
text. Postings are intersected per document; only the documents that satisfy a rule's query are
matched against it. A rule without mandatory trigrams (``hex``) is matched against every text.

A document is known by its position-free key, a hash of doc_id and text, so repeated rows and null
ids are handled; equal rows share postings. Nothing is grouped by trigram: the common ones do not
meet in a task. Offsets count code points and ends are exclusive.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterdeck.llm.trigrams import alternatives


class Rule(NamedTuple):
    kind: str
    pattern: str
    value_group: int  # the group that is the secret itself
    least: int  # its least number of characters


# The three base rules, then those that the index adds.
RULES = [
    Rule("assign", "((?i:password|passwd|secret|token|api_?key))[\"']?\\x20*[:=]\\x20*[\"']?"
                   "([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]{24,}", 0, 24),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 0, 36),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+", 0, 30),
    Rule("key", "-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----", 0, 20),
]
BASE = ("assign", "access", "hex")
SPAN = "array<struct<start:int,ord:int,end:int,kind:string>>"


def _matches(text: Column, rule: Rule, order: int) -> Column:
    """Spans of the leftmost non-overlapping matches: the parts between them and their lengths
    give the places; a match whose value is too short is dropped afterwards."""
    pattern, group = F.lit(rule.pattern), F.lit(rule.value_group)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    sizes = F.transform(found, F.length)
    values = sizes if rule.value_group == 0 else F.transform(
        F.regexp_extract_all(text, pattern, group), F.length)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    spans = F.aggregate(
        F.arrays_zip(gaps.alias("gap"), sizes.alias("size"), values.alias("value")),
        F.struct(F.lit(0).alias("at"), F.lit(None).cast(SPAN).alias("none"),
                 F.array().cast(SPAN).alias("spans")),
        lambda done, m: F.struct(
            (done["at"] + m["gap"] + F.coalesce(m["size"], F.lit(0))).alias("at"),
            done["none"].alias("none"),
            F.when(F.coalesce(m["value"], F.lit(0)) >= rule.least, F.concat(
                done["spans"], F.array(F.struct(
                    (done["at"] + m["gap"]).alias("start"), F.lit(order).alias("ord"),
                    (done["at"] + m["gap"] + m["size"]).alias("end"),
                    F.lit(rule.kind).alias("kind"))))).otherwise(done["spans"]).alias("spans")),
        lambda done: done["spans"])
    return F.when(F.regexp_like(text, pattern), spans).otherwise(F.array().cast(SPAN))


def _terms() -> dict[str, list[frozenset[str]]]:
    return {r.kind: alternatives(r.pattern) for r in RULES}


def _index(keyed: DataFrame, wanted: list[str]) -> DataFrame:
    """Postings (trigram, key) of the wanted trigrams."""
    low = F.lower("secret_text")
    present = F.array_compact(F.array(*[
        F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in wanted]))
    return keyed.select("secret_key", F.explode(present).alias("trigram"))


def _candidates(postings: DataFrame, terms: dict[str, list[frozenset[str]]]) -> DataFrame:
    """key and, by rule, whether its query holds: some alternative has all its postings."""
    def has(trigram: str) -> Column:
        return F.max(F.col("trigram") == trigram)

    rules = [F.greatest(*whole) if len(whole) > 1 else whole[0]
             for sets in terms.values() if frozenset() not in sets
             for whole in [[F.least(*map(has, sorted(s))) if len(s) > 1 else has(*s)
                            for s in sets]]]
    names = [k for k, sets in terms.items() if frozenset() not in sets]
    return (postings.groupBy("secret_key")
            .agg(*[r.alias(f"secret_in_{n}") for r, n in zip(rules, names)])
            .where(F.greatest(*[F.col(f"secret_in_{n}") for n in names])))


def find_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with ``secret_spans``, all spans by start, then rule. A null text is empty.

    Texts move once, to meet the documents' entries from the index.
    """
    terms = _terms()
    wanted = sorted({t for sets in terms.values() for s in sets for t in s})
    keyed = docs.withColumn("secret_text", F.coalesce(F.col("text"), F.lit(""))).withColumn(
        "secret_key", F.xxhash64("doc_id", "secret_text"))
    held = _candidates(_index(keyed, wanted), terms)
    text = F.col("secret_text")
    found = [F.when(F.col(f"secret_in_{r.kind}") if frozenset() not in terms[r.kind]
                    else F.lit(True), _matches(text, r, i)).otherwise(F.array().cast(SPAN))
             for i, r in enumerate(RULES)]
    return (keyed.join(held, "secret_key", "left")
            .withColumn("secret_spans", F.array_sort(F.concat(*found)))
            .select(*[F.col(f"`{c}`") for c in docs.columns], "secret_spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, the digest of their spans, and all spans."""
    found = find_secrets(docs.select("doc_id", "text"))
    spans = F.col("secret_spans")
    def of(*kinds: str) -> Column:
        return F.filter(spans, lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    base = of(*BASE)
    return found.select("doc_id", *counts, F.sha2(_joined(base), 256).alias("base_sha256"),
                        _joined(spans).alias("spans"))


def redact(docs: DataFrame, mark: str = "<secret>") -> DataFrame:
    """The same rows and columns; every span (overlapping ones together) is replaced by ``mark``
    in text, and n_chars follows the text. Documents without secrets are unchanged."""
    found = find_secrets(docs)
    text, spans = F.col("text"), F.col("secret_spans")
    cut = F.aggregate(
        spans, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda done, s: F.struct(
            F.when(s["start"] >= done["at"], F.concat(
                done["out"], F.substring(text, done["at"] + 1, s["start"] - done["at"]),
                F.lit(mark))).otherwise(done["out"]).alias("out"),
            F.greatest(done["at"], s["end"]).alias("at")),
        lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text))))
    new = F.when(F.size(spans) > 0, cut).otherwise(text)
    size = F.when(F.size(spans) > 0, F.length(cut).cast("long")).otherwise(F.col("n_chars"))
    return found.select(*[(new if c == "text" else size if c == "n_chars" else F.col(f"`{c}`"))
                          .alias(c) for c in docs.columns])

"""Base spans of patterns, positions in code points, in column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakewash.llm.common import let

SPAN = "array<struct<start:int,end:int,kind:string,ord:int,hit:string>>"


def running(values: Column, op) -> Column:
    """``op`` of each element and all before it, by doubling: step k joins each
    result with the one 2^k places before. Every step is one pass that builds one array, so a
    text with n matches costs n log n; appending to an array would cost n^2."""
    strides = F.transform(F.sequence(F.lit(0), F.floor(F.log2(F.greatest(F.size(values), F.lit(1)))).cast("int")),
                          lambda k: F.call_function("shiftleft", F.lit(1), k))
    return F.aggregate(strides, values, lambda done, d: F.transform(
        done, lambda x, i: F.when(i >= d, op(F.get(done, i - d), x)).otherwise(x)))


def pattern_spans(text: Column, pattern: str, kind: str, order: int, keep=None) -> Column:
    """Leftmost non-overlapping matches of ``pattern`` as spans.

    The pieces between matches and the matches themselves alternate, so each
    end is the running sum of the lengths up to it. A text without a match costs
    one search and no array; a long one with n matches costs n log n.
    ``keep(match)`` drops failing matches.
    """
    def spans(found: Column) -> Column:
        def placed(parts: Column) -> Column:
            lengths = F.transform(found, lambda hit, i: F.length(F.get(parts, i)) + F.length(hit))
            ends = let(lengths, lambda n: running(n, lambda before, own: before + own))
            return F.zip_with(found, ends, lambda hit, end: F.struct(
                (end - F.length(hit)).alias("start"), end.alias("end"), F.lit(kind).alias("kind"),
                F.lit(order).alias("ord"), hit.alias("hit")))
        return let(F.split(text, pattern, -1), placed)

    hits = F.when(text.rlike(pattern), let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans))
    if keep is not None:
        hits = F.filter(hits, lambda s: keep(s["hit"]))
    return F.coalesce(hits.cast(SPAN), F.array().cast(SPAN))


def digest(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined in the order given."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

"""Places of pattern matches inside texts, with built-in functions only.

``regexp_extract_all`` gives what matched but not where. ``split`` by the same
pattern gives what lies between, so a match starts after the pieces and the
matches before it. Lengths count code points. A text without a match costs
one ``rlike``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A place: ``hit`` is what matched, ``part`` one of its groups.
PLACE = "array<struct<start:int,end:int,hit:string,part:string>>"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once per row."""
    return F.transform(F.array(value), body)[0]


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, x: a + x)


def running(numbers: Column) -> Column:
    """Inclusive running sums of an int array, in blocks of about the square
    root of its size (so the work is its size to the power 1.5)."""
    def blocked(xs):
        width = F.ceil(F.sqrt(F.size(xs))).cast("int")
        blocks = F.transform(F.sequence(F.lit(0), F.ceil(F.size(xs) / width).cast("int") - 1),
                             lambda k: F.slice(xs, k * width + 1, width))
        return let(blocks, lambda bs: let(F.transform(bs, _total), lambda totals: F.flatten(F.transform(
            bs, lambda b, k: let(_total(F.slice(totals, F.lit(1), k)), lambda base: F.transform(
                b, lambda _, i: base + _total(F.slice(b, F.lit(1), i + 1))))))))
    return let(numbers, lambda xs: F.when(F.size(xs) == 0, F.array().cast("array<int>")).otherwise(blocked(xs)))


def find(text: Column, pattern: str, group: int = 0) -> Column:
    """All leftmost non-overlapping matches of ``pattern`` in ``text`` (array
    of PLACE, ends exclusive; null text: none)."""
    def places(hits, pieces, starts, parts):
        return F.transform(hits, lambda h, i: F.struct(
            starts[i].alias("start"), (starts[i] + F.length(h)).cast("int").alias("end"), h.alias("hit"),
            parts[i].alias("part")))

    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    found = let(hits, lambda h: let(F.split(text, pattern, -1), lambda p: let(
        running(F.transform(h, lambda _, i: F.length(p[i]) + F.coalesce(F.length(F.get(h, i - 1)), F.lit(0)))),
        lambda s: let(h if not group else F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
                      lambda g: places(h, p, s, g)))))
    return F.when(text.rlike(pattern), found.cast(PLACE)).otherwise(F.array().cast(PLACE))


def spell(spans: Column) -> Column:
    """``kind:start:end``, comma-joined in the array's order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def replace(text: Column, spans: Column, mark: str) -> Column:
    """``text`` with every span (sorted by start; they may overlap) replaced by ``mark``."""
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("cuts"))

    def step(a, s):
        fresh = F.struct(s["start"].alias("start"), s["end"].alias("end"))
        joined = F.concat(F.slice(a["cuts"], F.lit(1), F.size(a["cuts"]) - 1), F.array(F.struct(
            F.element_at(a["cuts"], -1)["start"].alias("start"), F.greatest(a["at"], s["end"]).alias("end"))))
        cuts = F.when((s["start"] >= a["at"]) | (F.size(a["cuts"]) == 0), F.concat(a["cuts"], F.array(fresh))).otherwise(joined)
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"), cuts.alias("cuts"))

    merged = F.aggregate(spans, empty, step, lambda a: a["cuts"])
    pieces = let(merged, lambda cuts: F.concat(
        F.transform(cuts, lambda c, i: F.concat(F.substring(
            text, F.coalesce(F.get(cuts, i - 1)["end"], F.lit(0)) + 1,
            c["start"] - F.coalesce(F.get(cuts, i - 1)["end"], F.lit(0))), F.lit(mark))),
        F.array(F.substring(text, F.element_at(cuts, -1)["end"] + 1, F.length(text)))))
    return F.when(F.size(spans) > 0, F.array_join(pieces, "")).otherwise(text)

"""Secrets by patterns and by character Markov models.

Base spans are the matches of three fixed patterns. Two first-order character models, one of random
strings and one of ordinary identifiers, add spans: a run of key characters is a secret when its
log-likelihood ratio per character passes a threshold. Both models are counted over the whole
corpus: values that the base patterns found are random strings, words of ordinary size in texts
without any finding are identifiers.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.durable import written
from tidemark.llm.text import bare

# The patterns of the base spans. A greedy run that is too short has no longer match
# inside, so the least size of ACCESS and HEX can stand in the pattern; that of ASSIGN cannot.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    r"|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
KINDS = ("assign", "access", "hex", "markov")

#: Runs of these characters are judged by the models. They are also the alphabet, in this order.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
RUN = r"[A-Za-z0-9+/_=-]{20,}"
#: Words that count as ordinary identifiers; longer runs are what is to be judged.
WORD = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{4,19}(?![A-Za-z0-9+/_=-])"
#: Log-likelihood ratio per character from which a run is a secret.
RATIO = 0.5


def _bound(value: Column, result: Callable[[Column], Column]) -> Column:
    """``result`` of a value that is computed once; named twice, or in a lambda, it is again each time."""
    return F.get(F.transform(F.array(value), result), F.lit(0))


def _found(text: Column, pattern: str, groups: int) -> Column:
    """Array of (start, end, value) of the leftmost matches; ``groups``: those of the pattern."""
    # Each match begins where the one before ended, so the text behind the last is read once.
    whole = rf"(?s)\G(.*?)({pattern})"
    part = lambda group: F.regexp_extract_all(text, F.lit(whole), group)
    parts = [part(1).alias("gaps"), part(2).alias("hits")]
    if groups:
        parts.append(part(2 + groups).alias("values"))

    def placed(found: Column) -> Column:
        hits = found["hits"]
        ends = _running(F.zip_with(found["gaps"], hits, lambda g, h: F.length(g) + F.length(h)))
        values = found["values"] if groups else hits
        joined = F.arrays_zip(ends.alias("end"), hits.alias("hit"), values.alias("value"))
        return F.transform(
            joined,
            lambda x: F.struct(
                (x["end"] - F.length(x["hit"])).alias("start"), x["end"].alias("end"),
                x["value"].alias("value"),
            ),
        )

    return _bound(F.struct(*parts), placed)


def _running(sizes: Column, block: int = 256) -> Column:
    """Running totals of an array, in blocks so that long arrays stay far from quadratic."""
    zero = F.lit(0)
    add = lambda a, b: a + b

    def blocks(sizes: Column) -> Column:
        last = F.floor((F.size(sizes) - 1) / block).cast("int")
        numbers = F.when(F.size(sizes) > 0, F.sequence(zero, last)).otherwise(F.array().cast("array<int>"))
        return F.transform(numbers, lambda k: F.slice(sizes, k * block + 1, block))

    def totals(parts: Column) -> Column:
        sums = F.transform(parts, lambda b: F.aggregate(b, zero, add))
        return _bound(sums, lambda t: F.zip_with(parts, before(t), inner))

    before = lambda sums: F.transform(
        sums, lambda _, k: F.aggregate(F.slice(sums, F.lit(1), k), zero, add)
    )
    inner = lambda b, start: F.transform(
        b, lambda _, i: start + F.aggregate(F.slice(b, F.lit(1), i + 1), zero, add)
    )
    return F.flatten(_bound(_bound(sizes, blocks), totals))


def _where(condition: Column, found: Column) -> Column:
    """The matches where a quick test says that there may be some."""
    kind = "array<struct<start: int, end: int, value: string>>"
    return F.when(condition, found).otherwise(F.array().cast(kind))


def _assigned(text: Column) -> Column:
    found = F.filter(_found(text, ASSIGN, 2), lambda x: F.length(x["value"]) >= LEAST_VALUE)
    return _where(text.rlike(ASSIGN), found)


def findings(documents: DataFrame) -> DataFrame:
    """``doc_id`` with arrays ``assign, access, hex`` of base spans and ``runs`` to be judged.

    Runs that overlap a base span are left out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = bare(documents).select(
        "doc_id", "text",
        _assigned(text).alias("assign"),
        _where(text.contains("AKIA"), _found(text, ACCESS, 0)).alias("access"),
        _where(text.rlike(HEX), _found(text, HEX, 0)).alias("hex"),
        _where(text.rlike(RUN), _found(text, RUN, 0)).alias("runs"),
    )
    return rows.withColumn("runs", _free(F.col("runs"), F.concat("assign", "access", "hex"))).drop("text")


def _places(array: Column, field: str) -> Column:
    return F.transform(array, lambda x: x[field])


def _among(runs: Column, others: Column, *, first: bool) -> Column:
    """For each of ascending numbers, how many of ``others`` are smaller, or as small unless ``first``.

    Both lists are sorted together; the i-th number at place p has p - i others before it.
    """
    marked = lambda values, mark: F.transform(
        values, lambda x: F.struct(x.alias("at"), F.lit(mark).alias("mark"))
    )
    own = 0 if first else 2
    both = F.sort_array(F.concat(marked(runs, own), marked(others, 1)))
    placed = F.transform(both, lambda x, p: F.struct(x["mark"].alias("mark"), p.alias("place")))
    return F.transform(F.filter(placed, lambda x: x["mark"] == own), lambda x, i: x["place"] - i)


def _free(runs: Column, base: Column) -> Column:
    """Runs that no base span overlaps, by two sorts instead of a comparison of all with all.

    Spans that begin before a run ends, less those that end before it begins, overlap it.
    """
    begun = _among(_places(runs, "end"), _places(base, "start"), first=True)
    ended = _among(_places(runs, "start"), _places(base, "end"), first=False)
    counted = F.arrays_zip(runs.alias("run"), begun.alias("begun"), ended.alias("ended"))
    return F.transform(F.filter(counted, lambda x: x["begun"] == x["ended"]), lambda x: x["run"])


def _pairs(values: DataFrame) -> DataFrame:
    """Counts of adjacent characters of ``value, times``, as places in the alphabet from 1 on."""
    codes = _codes(F.col("value"))
    after = F.slice(codes, F.lit(2), F.greatest(F.size(codes) - 1, F.lit(0)))
    both = F.explode(F.arrays_zip(codes.alias("a"), after.alias("b"))).alias("p")
    kept = values.select("times", both).where("p.a > 0 AND p.b > 0")
    return kept.groupBy(F.col("p.a").alias("a"), F.col("p.b").alias("b")).agg(F.sum("times").alias("n"))


def _codes(value: Column) -> Column:
    return F.transform(F.regexp_extract_all(value, F.lit("(?s)."), 0), lambda c: F.instr(F.lit(ALPHABET), c))


def _log_model(counts: dict[tuple[int, int], int], size: int, weight: float = 8.0) -> list[float]:
    """Log-probability of each character after each, smoothed by the character's own share."""
    after, of = [0.0] * size, [0.5] * size
    for (a, b), n in counts.items():
        after[a] += n
        of[b] += n
    total = sum(of)
    return [
        math.log((counts.get((a, b), 0) + weight * of[b] / total) / (after[a] + weight))
        for a in range(size) for b in range(size)
    ]


def train(documents: DataFrame, found: DataFrame) -> list[float]:
    """Log-likelihood ratios of adjacent characters, random over identifier, row by row.

    Random strings are the values of base spans and identifiers are words of texts without any, all
    of them in all documents. Words are counted first, so that characters are read once per
    distinct word. Where either is missing all ratios are 0.
    """
    random = found.select(F.explode(F.concat("assign", "access", "hex")).alias("x")).select("x.value")
    text = F.col("text")
    plain = bare(documents).where(
        ~(text.rlike(ACCESS) | text.rlike(HEX)) & (F.size(_assigned(text)) == 0)
    )
    ordinary = plain.select(F.explode(F.regexp_extract_all("text", F.lit(WORD), 0)).alias("value"))
    size = len(ALPHABET) + 1
    logs = []
    for each in (random, ordinary):
        values = each.groupBy("value").agg(F.count(F.lit(1)).alias("times"))
        counts = {(r["a"], r["b"]): r["n"] for r in _pairs(values).collect()}  # at most size ** 2
        if not counts:
            return [0.0] * (size * size)
        logs.append(_log_model(counts, size))
    return [x - y for x, y in zip(*logs, strict=True)]


def _ratio(value: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio of the adjacent characters of a run."""
    size = len(ALPHABET) + 1
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    # The state carries the character before, so the run is read once.
    start = F.struct(F.lit(0).alias("before"), F.lit(0.0).alias("sum"))
    step = lambda s, c: F.struct(
        c.alias("before"),
        (s["sum"] + F.when(s["before"] > 0, F.get(table, s["before"] * size + c)).otherwise(0.0)).alias("sum"),
    )
    return F.aggregate(_codes(value), start, step)["sum"] / (F.length(value) - 1)


def _line(spans: Column) -> Column:
    """Spans as ``kind:start:end`` by start, then kind as listed."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            F.sort_array(spans),
            lambda x: F.concat_ws(":", F.get(names, x["rank"]), x["start"].cast("string"), x["end"].cast("string")),
        ),
        ",",
    )


def secrets(documents: DataFrame, *, ratio: float = RATIO) -> DataFrame:
    """One row per document: ``doc_id, n_assign, n_access, n_hex, base, spans``.

    ``base`` lists the base spans and ``spans`` those and the spans that the models add, as
    ``kind:start:end`` in code points with exclusive ends, ordered by start and then kind, joined
    by commas. Null and empty texts have none. Rows are answered each by themselves, so null and
    repeated ids, repeated rows and further columns change nothing; an empty table gives an empty
    result.
    """
    found = written(findings(documents))
    ratios = train(documents, found)
    ranked = lambda column, k: F.transform(
        column, lambda x: F.struct(x["start"].alias("start"), F.lit(k).alias("rank"), x["end"].alias("end"))
    )
    base = F.concat(*[ranked(F.col(k), i) for i, k in enumerate(KINDS[:3])])
    more = ranked(F.filter("runs", lambda x: _ratio(x["value"], ratios) > ratio), 3)
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
        _line(base).alias("base"), _line(F.concat(base, more)).alias("spans"),
    )

"""Secret scans: patterns, and character Markov models for secrets that no pattern names.

Two first-order Markov models over characters, one of random strings and one
of ordinary identifiers, are trained from labelled samples. A run of token
characters whose log-likelihood ratio speaks for the random model is a span
of kind ``markov``. Everything is built-in expressions; the models are one
table of log ratios per pair of characters.
"""

from __future__ import annotations

import math
import string
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from celltide.llm.common import let, table, without

#: Fixed patterns of the base kinds, in their order; the last group is the value.
PATTERNS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"(AKIA[A-Z0-9]+)",
    "hex": r"([0-9a-f]{24,})",  # the runs of [0-9a-f]+ that are long enough: a run is matched whole or not at all
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = (*PATTERNS, "markov")
ALPHABET = string.ascii_letters + string.digits + "+/_=-"
RUN = "[A-Za-z0-9+/_=-]"
LEAST_RUN = 16
SAMPLE_DOCS = 10_000
_SPANS = "array<struct<start:int,kind:int,end:int>>"


def _spans(text: Column, pattern: str, kind: int, holds: Callable[[Column], Column]) -> Column:
    """``struct(start, kind, end)`` of matches whose last group ``holds``, in code points.

    Matches and the pieces between them alternate, so positions are sums of lengths.
    """
    regex = F.lit(pattern)

    def placed(matched: Column) -> Column:
        parts = F.arrays_zip(
            F.slice(F.split(text, pattern, -1), 1, F.size(matched)).alias("gap"),
            matched.alias("match"),
            F.regexp_extract_all(text, regex, F.lit(1)).alias("value"),
        )
        start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("spans"))

        def add(state: Column, part: Column) -> Column:
            begin = state["at"] + F.char_length(part["gap"])
            end = begin + F.char_length(part["match"])
            span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
            spans = F.when(holds(part["value"]), F.array_append(state["spans"], span)).otherwise(state["spans"])
            return F.struct(end.alias("at"), spans.alias("spans"))

        return F.aggregate(parts, start, add, lambda state: state["spans"])

    found = F.regexp_extract_all(text, regex, F.lit(0))
    return let(found, lambda m: F.when(F.size(m) == 0, F.array().cast(_SPANS)).otherwise(placed(m)))


def base_spans(text: Column) -> Column:
    """Spans of the three patterns by start, then kind."""
    kinds = [
        _spans(text, PATTERNS[name], i, lambda v, name=name: F.char_length(v) >= LEAST[name])
        for i, name in enumerate(PATTERNS)
    ]
    return F.array_sort(F.concat(*kinds))


def _pairs(value: Column) -> Column:
    """Places in the table of ratios: one per character, with the character before it or the start."""
    size = len(ALPHABET) + 1
    chars = F.filter(F.split(value, ""), lambda c: c != "")

    def place(char: Column) -> Column:
        return let(F.position(char, F.lit(ALPHABET)), lambda p: F.when(p > 0, p - 1).otherwise(size - 1))

    def paired(places: Column) -> Column:
        return F.transform(places, lambda c, i: F.coalesce(F.get(places, i - 1), F.lit(size)) * size + c)

    return let(F.transform(chars, place), paired)


@dataclass(frozen=True)
class CharModel:
    """Log-likelihood ratios, random over ordinary, by previous and next character.

    ``ratios`` has a row per character of the alphabet, one for all others and
    one for the start of the string. A string is random if its summed ratio
    reaches ``least_total`` and ``least_mean`` per character.
    """

    ratios: tuple[float, ...]
    least_total: float = 12.0
    least_mean: float = 0.5

    def score(self, value: Column) -> Column:
        """The summed log ratio of a string; 0 for an empty one."""
        # one constant, folded when the query is planned
        ratios = F.split(F.lit(",".join(map(repr, self.ratios))), ",").cast("array<double>")
        terms = F.transform(_pairs(value), lambda p: F.get(ratios, p))
        return F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)

    def is_random(self, value: Column) -> Column:
        least = F.greatest(F.lit(self.least_total), self.least_mean * F.char_length(value))
        return self.score(value) >= least


def train(samples: DataFrame, backing: float = 20.0, **limits: float) -> CharModel:
    """A model from labelled strings: columns ``value`` and boolean ``random``.

    Equal strings of a class count once; nulls are left out. Counts of pairs
    are backed by ``backing`` draws from the class's single characters, whose
    counts are smoothed by one: without samples every ratio is 0 and nothing
    is random. What comes to the driver is one row per pair of characters of the
    alphabet, however many samples there are.
    """
    size = len(ALPHABET) + 1
    pairs = samples.dropna(subset=["value", "random"]).select("value", "random").distinct()
    pairs = pairs.select("random", F.explode(_pairs(F.col("value"))).alias("pair"))
    found = pairs.groupBy("pair").agg(F.count_if("random").alias("r"), F.count_if(~F.col("random")).alias("o"))
    counts = {row.pair: (row.r, row.o) for row in found.collect()}
    chances = []
    for k in (0, 1):
        after = [[counts.get(p * size + c, (0, 0))[k] for c in range(size)] for p in range(size + 1)]
        single = [sum(row[c] for row in after) + 1 for c in range(size)]
        overall = [n / sum(single) for n in single]
        # a character seldom seen before is followed as characters are overall
        chances.append([(n + backing * q) / (sum(row) + backing) for row in after for n, q in zip(row, overall, strict=True)])
    ratios = [math.log(r) - math.log(o) for r, o in zip(*chances, strict=True)]
    return CharModel(tuple(ratios), **limits)


def labelled_samples(docs: DataFrame, text: str = "text", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Strings labelled by the patterns: values of base matches are random, other long runs ordinary.

    They come from about ``sample_docs`` documents, those with the smallest
    hashes of their texts (all, if there are fewer): a bounded sample to fit
    the models on. Scanning itself covers every document.
    """
    share = min(1.0, sample_docs / max(1, docs.count()))
    bits = F.pmod(F.xxhash64(F.lit("sample"), F.col(text)), F.lit(1 << 30))
    sampled = docs.where(F.col(text).isNotNull() & (bits < int(share * (1 << 30)))).select(F.col(text).alias("t"))

    def values(name: str) -> Column:
        found = F.regexp_extract_all("t", F.lit(PATTERNS[name]), F.lit(1))
        return F.filter(found, lambda v: F.char_length(v) >= LEAST[name])

    rest = F.col("t")
    for pattern in PATTERNS.values():
        rest = F.regexp_replace(rest, pattern, " ")
    ordinary = F.regexp_extract_all(rest, F.lit(f"({RUN}{{8,}})"), F.lit(1))
    labelled = F.concat(
        F.transform(F.concat(*map(values, PATTERNS)), lambda v: F.struct(v.alias("value"), F.lit(True).alias("random"))),
        F.transform(ordinary, lambda v: F.struct(v.alias("value"), F.lit(False).alias("random"))),
    )
    return sampled.select(F.inline(labelled))


def scan(docs: DataFrame, model: CharModel, text: str = "text") -> DataFrame:
    """Every row with ``base_spans`` and ``spans``: arrays of ``struct(start, kind, end)``.

    ``kind`` is a place in ``KINDS``; positions are code points, the end
    exclusive. ``spans`` adds to the base spans those of kind ``markov``: runs
    of 16 or more token characters outside base spans that the model takes for
    random; a run that base spans touch is cut there, and each piece is scored
    on its own. A null text counts as an empty one and has no spans.
    Equal rows get equal spans; input columns of the same names are replaced.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    kind = KINDS.index("markov")
    run = f"({RUN}{{{LEAST_RUN},}})"
    random = _spans(whole, run, kind, model.is_random)
    runs = _spans(whole, run, kind, lambda _: F.lit(True))

    def touching(s: Column, base: Column) -> Column:
        return F.filter(base, lambda b: (s["start"] < b["end"]) & (b["start"] < s["end"]))

    def outside(s: Column, touched: Column) -> Column:
        """What the base spans leave of a run: before each of them, and after the last."""
        none = F.struct(s["start"].alias("at"), F.array().cast(_SPANS).alias("spans"))

        def cut(state: Column, start: Column, end: Column) -> Column:
            piece = F.struct(state["at"].alias("start"), F.lit(kind).alias("kind"), start.alias("end"))
            long = start - state["at"] >= LEAST_RUN
            spans = F.when(long, F.array_append(state["spans"], piece)).otherwise(state["spans"])
            return F.struct(F.greatest(state["at"], end).alias("at"), spans.alias("spans"))

        return F.aggregate(touched, none, lambda state, b: cut(state, b["start"], b["end"]), lambda state: cut(state, s["end"], s["end"])["spans"])

    def pieces(base: Column) -> Column:
        def left(s: Column) -> Column:
            return let(touching(s, base), lambda t: F.when(F.size(t) == 0, F.array().cast(_SPANS)).otherwise(outside(s, t)))

        cut = F.flatten(F.transform(runs, left))
        is_random = lambda s: model.is_random(F.substr(whole, s["start"] + 1, s["end"] - s["start"]))
        return F.when(F.size(base) == 0, F.array().cast(_SPANS)).otherwise(F.filter(cut, is_random))

    def apart(base: Column) -> Column:
        untouched = F.filter(random, lambda s: F.size(touching(s, base)) == 0)
        return F.array_sort(F.concat(base, untouched, pieces(base)))

    return (
        without(docs, ["base_spans", "spans"])
        .withColumn("base_spans", base_spans(whole))
        .withColumn("spans", let(F.col("base_spans"), apart))
    )


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
    return F.array_join(F.transform(spans, one), ",")


def redact(scanned: DataFrame, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """Replace every span of ``spans`` by ``mask``; spans that overlap are replaced as one.

    Texts without spans, null and empty ones stay as they are.
    """
    whole = F.col(text)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def cut(state: Column, s: Column) -> Column:
        between = F.substr(whole, state["at"] + 1, s["start"] - state["at"])
        out = F.when(
            (s["start"] < state["at"]) | ((s["start"] == state["at"]) & (state["at"] > 0)), state["out"]
        ).otherwise(F.concat(state["out"], between, F.lit(mask)))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    masked = F.aggregate(
        F.col("spans"), start, cut, lambda s: F.concat(s["out"], F.substr(whole, s["at"] + 1, F.char_length(whole)))
    )
    return scanned.withColumn(text, F.when(F.size("spans") > 0, masked).otherwise(whole))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of all documents, models trained on a sample of them."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, train(labelled_samples(docs)))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{k}") for i, k in enumerate(PATTERNS)],
        F.sha2(listed(F.col("base_spans")), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )

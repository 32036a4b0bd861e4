"""Quality rules whose cutoffs are chosen under a bound on false rejections.

Counts come from array functions over the words of each text, without a shuffle. A rule rejects a text whose measure is beyond
its cutoff. For each stratum and rule, cutoffs are tried from the most lenient to the strictest on labelled documents: the
hypothesis that more than ``risk`` of the good ones are rejected has an exact binomial p-value, and the strictest cutoff
such that it and all more lenient ones are refuted is taken. Going through the cutoffs in fixed order needs no correction; the
strata and rules do, and each gets an equal part of ``error`` (Bonferroni). The rules share ``risk`` too, so that all of them
together reject at most ``risk`` of the good documents of every stratum with probability 1 - ``error``. A stratum with too few labels gets no cutoffs and keeps its documents.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .shared import written

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words_of(text: str | Column) -> Column:
    """Words of a text; null and blank texts have none."""
    blank = F.coalesce(F.btrim(text, F.lit(SPACE)), F.lit(""))
    return F.when(blank == "", F.array().cast("array<string>")).otherwise(F.split(blank, r"[\x20\x09-\x0D]+"))


def _gaps(starts: Column, n: int) -> Column:
    """Words covered by windows of ``n`` words at sorted starts."""
    later = F.zip_with(starts, F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), lambda a, b: F.when(b.isNull(), n).otherwise(F.least(b - a, F.lit(n))))
    return F.aggregate(later, F.lit(0), lambda s, x: s + x.cast("int"))


def counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_upper, n_lines, n_dup_lines and n_repeat_words of the whole text."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(F.split(body, "\n"), lambda s: F.btrim(s, F.lit(SPACE)) != "")
    df = docs.withColumn("__w", words_of(text)).withColumn("n_words", F.size("__w").cast("long"))
    df = df.withColumn("word_chars", F.length(F.translate(body, SPACE, "")).cast("long"))
    df = df.withColumn("n_symbols", (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("long"))
    df = df.withColumn("n_upper", (F.length(body) - F.length(F.translate(body, UPPER, ""))).cast("long"))
    df = df.withColumn("__lines", lines).withColumn("n_lines", F.size("__lines").cast("long"))
    df = df.withColumn("n_dup_lines", (F.col("n_lines") - F.size(F.array_distinct("__lines"))).cast("long")).drop("__lines")
    # Windows of three words: the upper 36 bits of a hash and the place in one number, which sorts fast.
    n = F.size("__w") - 2
    place = F.lit((1 << 28) - 1).cast("long")
    hashed = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)).bitwiseAND(F.lit(-1 << 28).cast("long")).bitwiseOR(i.cast("long")))
    df = df.withColumn("__h", F.when(n > 1, F.sort_array(hashed)).otherwise(F.array().cast("array<long>")))
    same = lambda a, b: a.isNotNull() & b.isNotNull() & (F.shiftright(a, 28) == F.shiftright(b, 28))
    near = F.filter("__h", lambda x, i: same(x, F.get("__h", i + 1)) | (i > 0) & same(x, F.get("__h", F.greatest(i - 1, F.lit(0)))))
    df = df.withColumn("__near", F.transform(near, lambda x: x.bitwiseAND(place).cast("int"))).drop("__h")
    # Only those that look alike are compared by their words.
    triple = lambda i: F.struct(F.get("__w", i).alias("a"), F.get("__w", i + 1).alias("b"), F.get("__w", i + 2).alias("c"), i.alias("i"))
    df = df.withColumn("__t", F.sort_array(F.transform("__near", triple))).drop("__near", "__w")
    alike = lambda x, y: (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
    twice = F.filter("__t", lambda x, i: F.coalesce(alike(x, F.get("__t", i + 1)), F.lit(False)) | (i > 0) & alike(x, F.get("__t", F.greatest(i - 1, F.lit(0)))))
    df = df.withColumn("__at", F.sort_array(F.transform(twice, lambda x: x["i"]))).drop("__t")
    return df.withColumn("n_repeat_words", _gaps(F.col("__at"), 3).cast("long")).drop("__at")


@dataclass(frozen=True)
class Rule:
    """Rejects where ``measure`` is above the cutoff. ``cutoffs`` go from the most lenient to the strictest."""

    name: str
    measure: Column
    cutoffs: tuple[float, ...]


def rules() -> list[Rule]:
    """The standard rules over ``counts``."""
    chars, words = F.greatest("word_chars", F.lit(1)), F.greatest("n_words", F.lit(1))
    ratio = tuple(round(0.9 - 0.05 * k, 2) for k in range(17))
    return [
        Rule("symbols", F.col("n_symbols") / chars, (0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.05, 0.04, 0.03, 0.02, 0.01)),
        Rule("repeats", F.col("n_repeat_words") / words, ratio),
        Rule("dup_lines", F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)), ratio),
        Rule("upper", F.col("n_upper") / chars, ratio),
    ]


def tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X binomial (n, p), exact; 1 where k reaches the mean, which no test refutes."""
    choose = F.aggregate(F.sequence(F.lit(1), F.greatest(k, F.lit(1))), F.lit(0.0), lambda s, j: s + F.when(k > 0, F.ln((n - k + j) / j)).otherwise(0.0))
    last = F.exp(choose + k * F.ln(F.lit(p)) + (n - k) * F.ln(F.lit(1 - p)))
    start = F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s"))

    def step(x: Column, j: Column) -> Column:
        i = k - j + 1
        t = x["t"] * i * (1 - p) / ((n - i + 1) * p)
        return F.when(k > 0, F.struct(t.alias("t"), (x["s"] + t).alias("s"))).otherwise(x)

    total = F.aggregate(F.sequence(F.lit(1), F.greatest(k, F.lit(1))), start, step, lambda x: x["s"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.least(last * total, F.lit(1.0)))


def cutoffs(measured: DataFrame, labelled: DataFrame, using: Sequence[Rule], stratum: str, key: str, good: Column, risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """(stratum, rule, cutoff, n, rejected, p_value): the strictest cutoff that is safe; none where no cutoff is.

    ``measured`` has a column per rule, named after it. ``labelled`` rows match it by ``key``; rows whose ``good`` is not true do not
    count. A document with several labels counts once for each.
    """
    strata = measured.select(stratum).distinct()
    tests = strata.agg(F.greatest(F.count("*"), F.lit(1)).alias("m"))
    calm = labelled.where(good).select(key).join(measured, key)
    tried = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(i).alias("step"), F.lit(c).alias("cutoff"), (F.col(r.name) > c).cast("int").alias("hit")) for r in using for i, c in enumerate(r.cutoffs)])
    hits = calm.select(stratum, F.explode(tried).alias("t")).groupBy(stratum, "t.rule", "t.step", "t.cutoff").agg(F.count("*").alias("n"), F.sum("t.hit").alias("rejected"))
    level = F.lit(error / len(using)) / tests.select("m").scalar()
    tested = hits.withColumn("p_value", tail(F.col("rejected"), F.col("n"), risk / len(using))).withColumn("safe", F.col("p_value") <= level)
    before = Window.partitionBy(stratum, "rule").orderBy("step")
    run = tested.withColumn("so_far", F.min("safe").over(before)).where("so_far")
    best = run.groupBy(stratum, "rule").agg(F.max_by(F.struct("cutoff", "n", "rejected", "p_value"), "step").alias("b"))
    return best.select(stratum, "rule", "b.cutoff", "b.n", "b.rejected", "b.p_value")


def verdicts(docs: DataFrame, labelled: DataFrame, good: Column, key: str = "doc_id", text: str = "text", stratum: str = "lang", using: Sequence[Rule] | None = None, risk: float = 0.02, error: float = 0.05) -> DataFrame:
    """(key, stratum, counts, base_failed, kept) for every row of ``docs``.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated windows of three. ``kept`` is false
    for those and for texts beyond a safe cutoff of their stratum. Null texts have no words; null strata are a stratum
    of their own; null keys have no labels. Repeated rows each get a row. Only the named columns are looked at.
    """
    using = rules() if using is None else list(using)
    base = counts(docs.select(key, F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("__stratum"), F.col(text).alias("__text")), "__text").drop("__text")
    # Narrow: a few numbers per document. The texts are read once.
    base = written(base.select("*", *[r.measure.alias(r.name) for r in using]), "counts")
    safe = written(cutoffs(base, labelled, using, "__stratum", key, good, risk, error), "cutoffs")
    # A row per stratum with a cutoff per rule.
    wide = safe.groupBy("__stratum").agg(*[F.min(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"__{r.name}") for r in using])
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    beyond = F.lit(False)
    for r in using:
        beyond = beyond | F.coalesce(F.col(r.name) > F.col(f"__{r.name}"), F.lit(False))
    out = base.join(wide, "__stratum", "left")
    return out.select(key, F.col("__stratum").alias(stratum), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_lines", failed.alias("base_failed"), (~failed & ~beyond).alias("kept"))

"""Host-level quality rules (DataFrame functions only).

Every document is measured by five rules. Failures are counted per (host,
rule); each host's rate is shrunk with a beta prior fitted to all hosts of that
rule (method of moments); a host whose failure rate is above ``limit`` with
confidence (posterior mean less ``z`` standard deviations) is blocked, and its
verdict is joined back to the documents. A document is kept when it fails no
rule itself and its host isn't blocked.

Words are runs of anything but ``\\x20`` and ``\\x09-\\x0D``. The rules:

* ``short``: fewer than 50 words;
* ``repeat``: over half of the words stand in 3-word windows found twice or more;
* ``symbols``: more than one of ``#*$%&|<>`` for ten words;
* ``dup_lines``: over half of the lines with a word repeat an earlier line;
* ``word_length``: a mean word length outside 2 to 15 code points.

Defined results: null or empty text has no words and fails ``short`` only; a
null host is a host of its own; repeated rows count as often as they occur; an
empty table gives an empty result. Input columns are carried as one struct, so
their names can't clash with the measures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import materialize
from .columns import once

WORD_BREAK = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
RULES = ("short", "repeat", "symbols", "dup_lines", "word_length")
#: The rules of the contract's base verdict.
BASE_RULES = ("short", "repeat")
BLOCK_LIMIT = 0.5
BLOCK_Z = 3.0
#: The prior weighs at least and at most so many documents.
PRIOR_WEIGHT = (2.0, 10_000.0)


#: Positions take this many low bits where windows are sorted as numbers.
_POS_BITS = 20
_POS_MASK = (1 << _POS_BITS) - 1


def _window(h: Column, i: Column) -> Column:
    """Hash of the 3-word window at position ``i``."""
    return F.xxhash64(h[i], h[i + 1], h[i + 2])


def _positions(h: Column) -> Column:
    return F.transform(F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0))), lambda _, i: i)


def _pairs(c: Column) -> Column:
    """Members of ``c`` (sorted, packed windows) that share their hash bits with a neighbour."""
    def pair(a, b):
        return F.when(F.shiftrightunsigned(a.bitwiseXOR(b), _POS_BITS) == 0, F.array(a, b))
    return F.array_distinct(F.flatten(F.filter(F.zip_with(c, F.slice(c, 2, F.greatest(F.size(c), F.lit(1))), pair), lambda p: p.isNotNull())))


def _differ(h: Column, hits: Column) -> Column:
    """Some members with equal hash bits are different windows."""
    place = lambda x: x.bitwiseAND(F.lit(_POS_MASK)).cast("int")
    return F.exists(F.zip_with(hits, F.slice(hits, 2, F.greatest(F.size(hits), F.lit(1))), lambda a, b: (
        F.shiftrightunsigned(a.bitwiseXOR(b), _POS_BITS) == 0) & (_window(h, place(a)) != _window(h, place(b)))), lambda v: F.coalesce(v, F.lit(False)))


def _covered(starts: Column) -> Column:
    """How many words lie in 3-word windows at these ascending positions."""
    step = F.aggregate(
        starts, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).cast("long").alias("last")),
        lambda a, s: F.struct((a["n"] + F.least(F.lit(3).cast("long"), s - a["last"])).alias("n"), s.alias("last")))
    return step["n"]


def _starts_by_pairs(h: Column) -> Column:
    """Positions of repeated windows from sorted (hash, position) pairs."""
    pairs = F.sort_array(F.transform(_positions(h), lambda i: F.struct(_window(h, i).alias("x"), i.cast("long").alias("i"))))

    def places(p):
        hits = F.filter(p, lambda e, j: (e["x"] == F.get(p, j - 1)["x"]) | (e["x"] == F.get(p, j + 1)["x"]))
        return F.sort_array(F.transform(hits, lambda e: e["i"]))
    return once(pairs, places)


def measure(docs: DataFrame, text_col: str = "text", host_col: str = "source",
            keep: list[str] | None = None) -> DataFrame:
    """``row`` (the kept input columns), ``host``, the measures and one flag per rule.

    Repeated windows: each window's hash, its low bits replaced by its position,
    is sorted as a plain number; equal neighbours repeat. Should two different
    windows agree in the remaining bits, or a text have more words than the
    position bits can number, whole hashes are sorted with their positions.
    The steps are separate projections, so that each array is made once and
    the sorting runs in generated code.
    """
    names = docs.columns if keep is None else keep
    lines = F.filter(F.split("text", "\n"), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    d = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(host_col).cast("string").alias("host"),
                    F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    d = d.select("row", "host",
                 F.filter(F.split("text", WORD_BREAK), lambda w: w != "").alias("words"),
                 F.length(F.regexp_replace("text", f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
                 F.when(F.instr("text", "\n") > 0, once(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("dup")))).alias("lines"))
    d = d.select("row", "host", "n_symbols", "lines", F.size("words").cast("long").alias("n_words"),
                 F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
                 F.transform("words", lambda w: F.xxhash64(w)).alias("h"))
    h, c, hits = F.col("h"), F.col("c"), F.col("hits")
    packed = F.transform(_positions(h), lambda i: _window(h, i).bitwiseAND(F.lit(~_POS_MASK)).bitwiseOR(i.cast("long")))
    d = d.withColumn("c", F.sort_array(packed))
    d = d.withColumn("hits", _pairs(c))
    unsure = (F.col("n_words") > _POS_MASK) | _differ(h, hits)
    repeated = (F.when(F.size(hits) == 0, 0).when(unsure, _covered(_starts_by_pairs(h)))
                .otherwise(_covered(F.sort_array(F.transform(hits, lambda x: x.bitwiseAND(F.lit(_POS_MASK)))))))
    d = d.select("row", "host", "n_words", "word_chars", "n_symbols", F.coalesce("lines.n", F.lit(0)).cast("long").alias("n_lines"),
                 F.coalesce("lines.dup", F.lit(0)).cast("long").alias("n_dup_lines"), repeated.cast("long").alias("n_repeat_words"))
    n = F.col("n_words")
    flags = {"short": n < 50,
             "repeat": 100 * F.col("n_repeat_words") > 50 * n,
             "symbols": 10 * F.col("n_symbols") > n,
             "dup_lines": 2 * F.col("n_dup_lines") > F.col("n_lines"),
             "word_length": (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 15 * n)}
    return d.select(*[c for c in d.columns if c != "n_lines"], *[(flags[r]).alias(f"fails_{r}") for r in RULES])


def host_rates(measured: DataFrame, limit: float = BLOCK_LIMIT, z: float = BLOCK_Z) -> DataFrame:
    """One row per (host, rule): documents, failures, posterior mean and bound, ``blocked``."""
    by_host = measured.groupBy("host").agg(F.count("*").alias("n"), *[F.count_if(f"fails_{r}").alias(r) for r in RULES])
    long = by_host.select("host", "n", F.inline(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("f")) for r in RULES])))
    rate = F.col("f") / F.col("n")
    total, failed, hosts = F.sum("n").cast("double"), F.sum("f"), F.count("*")
    m = F.col("m")
    prior = (long.groupBy("rule").agg((failed / total).alias("m"), total.alias("total"), hosts.alias("hosts"),
                                      F.sum(F.col("n") * rate * rate).alias("sq"))
             # spread between the hosts, less what sampling alone gives
             .withColumn("var", F.col("sq") / F.col("total") - m * m - m * (1 - m) * (F.col("hosts") - 1) / F.col("total"))
             .select("rule", "m", F.when(F.col("var") > 0, F.greatest(F.lit(PRIOR_WEIGHT[0]), F.least(
                 F.lit(PRIOR_WEIGHT[1]), m * (1 - m) / F.col("var") - 1))).otherwise(PRIOR_WEIGHT[1]).alias("weight")))
    a, b = F.col("f") + m * F.col("weight"), F.col("n") - F.col("f") + (1 - m) * F.col("weight")
    mean = a / (a + b)
    bound = mean - z * F.sqrt(mean * (1 - mean) / (a + b + 1))
    return (long.join(prior, "rule").select("host", "rule", "n", "f", mean.alias("rate"), bound.alias("bound"))
            .withColumn("blocked", F.col("bound") > limit))


def quality_rules(docs: DataFrame, text_col: str = "text", host_col: str = "source", keep: list[str] | None = None,
                  limit: float = BLOCK_LIMIT, z: float = BLOCK_Z) -> DataFrame:
    """``row``, ``host``, the measures, ``base_failed``, ``host_blocked`` and ``kept`` of every document.

    The measures are written to the shared folder once: the hosts' counts and
    the result both read them. The blocked hosts are written too, so the
    planner knows their size when it joins them (broadcast if small, otherwise
    a sort-merge join whose hot hosts adaptive execution splits).
    """
    measured = materialize(measure(docs, text_col, host_col, keep), "quality-measures")
    blocked = materialize(host_rates(measured, limit, z).filter("blocked").select(F.col("host").alias("bad_host")).distinct(), "quality-hosts")
    joined = measured.join(blocked, measured.host.eqNullSafe(blocked.bad_host), "left_semi").select("*", F.lit(True).alias("host_blocked"))
    rest = measured.join(blocked, measured.host.eqNullSafe(blocked.bad_host), "left_anti").select("*", F.lit(False).alias("host_blocked"))
    fails = F.lit(False)
    for r in RULES:
        fails = fails | F.col(f"fails_{r}")
    base = F.col("fails_short") | F.col("fails_repeat")
    return (joined.unionAll(rest).withColumn("base_failed", base)
            .withColumn("kept", ~fails & ~F.col("host_blocked")))


def keep_good(docs: DataFrame) -> DataFrame:
    """The kept documents, with the columns of ``docs``."""
    return quality_rules(docs).filter("kept").select("row.*")

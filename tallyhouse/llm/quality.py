"""Quality rules with cutoffs whose false rejections are bounded.

Base rules (too few words, mostly repeated windows) always hold. Beyond them every document has
a severity from 0 to ``LEVELS``, the worst of five rates (symbols, duplicate lines, repeated
windows, capitals, exclamation marks), all in whole numbers. Which severity rejects is chosen per
stratum, the language, from labelled documents:

* For each cutoff, ``k`` of the stratum's ``n`` good documents would be rejected. The cutoff is
  certified if a true rejection rate of ``alpha`` would show ``k`` or fewer with a probability of
  at most ``delta`` divided by the number of strata. That is the exact one-sided binomial (Clopper
  and Pearson) bound. Cutoffs are nested and tested from the highest down, in an order fixed before
  the data, and the first that fails ends a stratum's tests; so cutoffs need no correction among
  themselves, strata are corrected by Bonferroni, and with probability 1 - delta no chosen cutoff
  rejects more than ``alpha`` of a stratum's good documents.
* The trials are distinct documents: an id counts once in a stratum, with its worst severity, and
  as bad if any of its labels says so, however often its row or its label is repeated.
* Among certified cutoffs the one that separates bad from good best is used; a stratum without any
  keeps all that the base rules keep.

Everything is DataFrame functions. A text's windows are counted inside its row by sorting their
hashes, so no row per word ever exists and no shuffle carries words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tallyhouse.llm.shared import WORD, column, free_name, stage

LEVELS = 20
FEATURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
_MORE = ["n_lines", "n_capitals", "n_marks"]


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def with_features(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` and the counted columns; returns also their names, free of clashes.

    Each step reads columns of the one before more than once, so the optimizer keeps them apart
    and a text is split and hashed once.
    """
    names, df = {}, docs
    for wish in ["whole", "words", "lines", "hashes", "windows", "repeats", *FEATURES, *_MORE]:
        names[wish] = free_name(docs, f"q_{wish}")
    n, at = names, lambda wish: F.col(f"`{names[wish]}`")
    df = df.withColumn(n["whole"], F.coalesce(column(docs, text_col, "string"), F.lit("")))
    df = df.withColumns({
        n["words"]: F.regexp_extract_all(at("whole"), F.lit(WORD), F.lit(0)),
        n["lines"]: F.filter(F.split(at("whole"), "\n", -1), lambda x: x.rlike(WORD)),
    })
    df = df.withColumns({
        n["n_words"]: F.size(at("words")).cast("long"),
        n["word_chars"]: F.length(F.array_join(at("words"), "")).cast("long"),
        n["n_symbols"]: _count(at("whole"), "#*$%&|<>"),
        n["n_lines"]: F.size(at("lines")).cast("long"),
        n["n_dup_lines"]: (F.size(at("lines")) - F.size(F.array_distinct(at("lines")))).cast("long"),
        n["n_capitals"]: F.regexp_count(at("whole"), F.lit(r"\p{Lu}")).cast("long"),
        n["n_marks"]: _count(at("whole"), "!"),
        n["hashes"]: F.transform(at("words"), lambda w: F.xxhash64(w)),
    }).drop(n["words"], n["lines"], *([n["whole"]]))
    window = lambda x, i: F.struct(F.xxhash64(x, F.get(at("hashes"), i + 1), F.get(at("hashes"), i + 2)).alias("h"), i.alias("i"))
    starts = F.slice(at("hashes"), F.lit(1), F.greatest(F.size(at("hashes")) - 2, F.lit(0)))
    df = df.withColumn(n["windows"], F.sort_array(F.transform(starts, window))).drop(n["hashes"])
    twin = lambda x, i: (x["h"] == F.get(at("windows"), i - 1)["h"]) | (x["h"] == F.get(at("windows"), i + 1)["h"])
    repeats = F.sort_array(F.transform(F.filter(at("windows"), twin), lambda x: x["i"]))
    df = df.withColumn(n["repeats"], repeats).drop(n["windows"])
    covered = F.aggregate(
        at("repeats"),
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n")),
        lambda acc, x: F.struct(x.alias("last"), (acc["n"] + F.least(F.lit(3), x - acc["last"])).alias("n")),
        lambda acc: acc["n"],
    )
    return df.withColumn(n["n_repeat_words"], covered).drop(n["repeats"]), names


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < 50) | (100 * n_repeat_words > 50 * n_words)


def severity(at) -> Column:
    """0 to ``LEVELS``; a step is 1 % symbols, 5 % duplicate lines, 2.5 % repeated words, 2.5 % capitals or a mark per 20 words."""
    rate = lambda part, whole, steps: F.floor(steps * at(part) / F.greatest(at(whole), F.lit(1)))
    return F.least(
        F.lit(LEVELS),
        F.greatest(
            rate("n_symbols", "word_chars", 100),
            rate("n_dup_lines", "n_lines", 20),
            rate("n_repeat_words", "n_words", 40),
            rate("n_capitals", "word_chars", 40),
            rate("n_marks", "n_words", 20),
        ),
    ).cast("int")


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """Probability of at most ``k`` of ``n`` at rate ``p``, exactly; 1 where k exceeds the mean."""
    odds = F.log(F.lit(p / (1 - p)))
    start = n * F.log(F.lit(1 - p))
    step = lambda acc, i: F.struct(
        (acc["term"] + F.log((n - i + 1) / i) + odds).alias("term"),
        (acc["total"] + F.exp(acc["term"] + F.log((n - i + 1) / i) + odds)).alias("total"),
    )
    terms = F.when(k >= 1, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.expr("cast(array() as array<bigint>)"))
    total = F.aggregate(terms, F.struct(start.alias("term"), F.exp(start).alias("total")), step, lambda acc: acc["total"])
    return F.when(k > n * p, F.lit(1.0)).otherwise(total)


def cutoffs(scored: DataFrame, labels: DataFrame, alpha: float = 0.01, delta: float = 0.05) -> DataFrame:
    """stratum, cutoff: the severity from which a stratum rejects.

    ``scored`` has doc_id, stratum, severity of documents that pass the base rules; ``labels`` has
    doc_id, quality (1 good, 0 bad; others are ignored). The histogram has at most ``LEVELS`` + 1
    rows a stratum, whatever the number of labels.
    """
    known = labels.select(column(labels, "doc_id", "long").alias("doc_id"), column(labels, "quality", "int").alias("quality")).where("quality in (0, 1)")
    trials = scored.join(known, "doc_id").groupBy("stratum", "doc_id").agg(F.max("severity").alias("severity"), F.min("quality").alias("quality"))
    seen = trials.groupBy("stratum", "severity").agg(
        F.count(F.when(F.col("quality") == 1, 1)).alias("good"), F.count(F.when(F.col("quality") == 0, 1)).alias("bad")
    )
    # One row a stratum with its histogram as a map, then one row a cutoff.
    by = seen.groupBy("stratum").agg(F.collect_list(F.struct("severity", "good", "bad")).alias("levels"))
    total = lambda part, least: F.aggregate(
        F.filter("levels", lambda x: x["severity"] >= least), F.lit(0).cast("long"), lambda acc, x: acc + x[part]
    )
    tests = by.withColumn("cutoff", F.explode(F.sequence(F.lit(1), F.lit(LEVELS)))).select(
        "stratum", "cutoff",
        total("good", F.lit(0)).alias("n"), total("good", F.col("cutoff")).alias("k"),
        total("bad", F.lit(0)).alias("m"), total("bad", F.col("cutoff")).alias("hits"),
    )
    number = by.agg(F.count(F.lit(1)).alias("tests"))  # one row
    # k grows as the cutoff falls, so the tails do: what passes here is what passes before the first failure.
    certified = tests.crossJoin(F.broadcast(number)).where(binomial_tail(F.col("n"), F.col("k"), alpha) * F.col("tests") <= delta)
    gain = F.col("hits") / F.greatest(F.col("m"), F.lit(1)) - 5 * F.col("k") / F.greatest(F.col("n"), F.lit(1))
    best = F.max(F.struct(gain.alias("gain"), F.col("cutoff"))).alias("best")
    return certified.where("hits > 0").groupBy("stratum").agg(best).select("stratum", F.col("best.cutoff").alias("cutoff"))


def _judged(docs: DataFrame, labels: DataFrame, carry: list[str], alpha: float, delta: float, id_col: str, text_col: str, stratum_col: str) -> tuple[DataFrame, dict[str, str]]:
    """``carry`` columns, counted columns, ``failed``, ``severity`` and ``kept`` under free names."""
    df, names = with_features(docs, text_col)
    for wish in ["id", "stratum", "severity", "failed", "cutoff", "kept"]:
        names[wish] = free_name(docs, f"q_{wish}")
    at = lambda wish: F.col(f"`{names[wish]}`")
    df = df.withColumns({
        names["id"]: column(docs, id_col, "long"),
        names["stratum"]: F.concat(F.when(column(docs, stratum_col, "string").isNull(), "-").otherwise("+"), F.coalesce(column(docs, stratum_col, "string"), F.lit(""))),
        names["severity"]: severity(at),
        names["failed"]: base_failed(at("n_words"), at("n_repeat_words")),
    })
    made = ["id", "stratum", "severity", "failed", *FEATURES, *_MORE]
    df = stage(df.select(*[F.col(f"`{c}`") for c in carry], *[at(w) for w in made]), "quality")
    scored = df.where(~at("failed")).select(at("id").alias("doc_id"), at("stratum").alias("stratum"), at("severity").alias("severity"))
    chosen = stage(cutoffs(scored, labels, alpha, delta), "cutoffs").select(F.col("stratum").alias(names["stratum"]), F.col("cutoff").alias(names["cutoff"]))
    judged = df.join(chosen, names["stratum"], "left")  # a row per stratum; Spark decides by its size
    kept = ~at("failed") & F.coalesce(at("severity") < at("cutoff"), F.lit(True))
    return judged.withColumn(names["kept"], kept), names


def quality_rules(docs: DataFrame, labels: DataFrame, alpha: float = 0.01, delta: float = 0.05, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, severity, cutoff per row.

    Null and empty texts have no words and fail the base rules. Repeated rows give repeated
    results, repeated label rows change nothing, a null stratum is a stratum, tables
    without labels certify nothing, an empty table gives no rows. Extra columns are ignored.
    """
    judged, names = _judged(docs, labels, [], alpha, delta, id_col, text_col, stratum_col)
    at = lambda wish: F.col(f"`{names[wish]}`")
    return judged.select(
        at("id").alias("doc_id"), *[at(f).alias(f) for f in FEATURES], at("failed").alias("base_failed"), at("kept").alias("kept"),
        at("severity").alias("severity"), at("cutoff").alias("cutoff"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with the same columns."""
    defaults = {"alpha": 0.01, "delta": 0.05, "id_col": "doc_id", "text_col": "text", "stratum_col": "lang"}
    judged, names = _judged(docs, labels, docs.columns, **(defaults | settings))
    return judged.where(F.col(f"`{names['kept']}`")).select([F.col(f"`{c}`") for c in docs.columns])

"""Host-level quality rules, in DataFrame functions alone.

Rules are judged for each document; their failures are added up by host; the
hosts' rates are shrunk towards a beta prior fitted to all hosts, so that a host
with few documents is not condemned by chance; the verdicts go back to the
documents by a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .base import documents, mark, stored

WHITE = " \t\n\x0b\f\r"
#: A host goes if the shrunk share of its documents that fail one rule is above this.
MOST_FAILING = 0.5
#: Hosts up to this number are broadcast to the documents; more are joined by shuffle.
BROADCAST_HOSTS = 100_000
#: The rules whose failures are added up by host; the first two reject a document by themselves.
RULES = {
    "short": lambda f: f["n_words"] < 10,
    "repetitive": lambda f: f["n_repeat_words"] * 100 > f["n_words"] * 20,
    "dup_lines": lambda f: f["n_dup_lines"] * 100 > f["n_lines"] * 30,
    "symbols": lambda f: f["n_symbols"] * 10 > f["n_words"],
}


def _repeat_words(grams: Column) -> Column:
    """Words inside 5-word windows that occur twice or more, by the windows' hashes."""
    pairs = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def again(x: Column, pairs: Column) -> Column:
        places = F.transform(pairs, lambda p, j: F.when((F.get(pairs, j - 1)["h"] == p["h"]) | (F.get(pairs, j + 1)["h"] == p["h"]), p["i"]))
        return F.sort_array(F.filter(places, lambda p: p.isNotNull()))

    # One array of one element holds the sorted pairs, so they are made once.
    positions = F.flatten(F.transform(F.array(pairs), lambda p: again(p, p)))
    first = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-5).alias("last"))
    return F.aggregate(positions, first, lambda a, p: F.struct((a["n"] + F.least(F.lit(5), p - a["last"])).cast("long").alias("n"), p.alias("last")), lambda a: a["n"])


def with_features(docs: DataFrame, text: str = "text", out: str = "features") -> DataFrame:
    """docs with a struct of n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    A null or empty text has no words and no lines; texts of any length are
    counted whole; repeated rows get equal counts; an empty table stays empty. A
    column named `out` is replaced, all others pass through. Nothing is shuffled.
    """
    names = [c for c in docs.columns if c.lower() != out.lower()]
    m = mark(names)
    t = F.coalesce(F.col(text), F.lit(""))
    words = F.split(F.btrim(t, F.lit(WHITE)), f"[{WHITE}]+")
    col = lambda c: F.col(m + c)
    step = docs.select(
        *names,
        F.when(F.btrim(t, F.lit(WHITE)) == "", F.array().cast("array<string>")).otherwise(words).alias(m + "words"),
        F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != "").alias(m + "lines"),
        F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias(m + "symbols"),
    )
    step = step.select(
        *names, m + "lines", m + "symbols", F.size(m + "words").cast("long").alias(m + "n"),
        F.char_length(F.array_join(m + "words", "")).cast("long").alias(m + "chars"), F.transform(m + "words", lambda w: F.xxhash64(w)).alias(m + "hashes"),
    )
    window = [lambda i, k=k: F.get(col("hashes"), i + k) for k in range(5)]
    grams = F.transform(F.sequence(F.lit(0), (col("n") - 5).cast("int")), lambda i: F.xxhash64(*(w(i) for w in window)))
    step = step.withColumn(m + "grams", F.when(col("n") >= 5, grams).otherwise(F.array().cast("array<bigint>"))).drop(m + "hashes")
    repeat = F.when(F.size(F.array_distinct(m + "grams")) == F.size(m + "grams"), F.lit(0).cast("long")).otherwise(_repeat_words(col("grams")))
    return step.select(
        *names,
        F.struct(
            col("n").alias("n_words"), col("chars").alias("word_chars"), col("symbols").alias("n_symbols"),
            F.size(m + "lines").cast("long").alias("n_lines"), (F.size(m + "lines") - F.size(F.array_distinct(m + "lines"))).cast("long").alias("n_dup_lines"),
            repeat.alias("n_repeat_words"),
        ).alias(out),
    )


def base_failed(f: Column) -> Column:
    return RULES["short"](f) | RULES["repetitive"](f)


def host_verdicts(features: DataFrame, host: str, out: str = "features", most: float = MOST_FAILING) -> DataFrame:
    """One row per host (null is a host): `host`, `host_docs`, `rate_<rule>` shrunk, `host_ok`.

    The prior of each rule is a beta distribution with the mean and the spread
    of the hosts' rates (moments, weighted by documents, without the binomial
    noise); a host's rate is (failures + a) / (documents + a + b). Counts are
    added up on the map side; only the two moments of each rule go to the driver.
    """
    f = F.col(out)
    hosts = features.groupBy(F.col(host).alias("host")).agg(F.count(F.lit(1)).alias("host_docs"), *(F.count_if(rule(f)).alias(f"fail_{k}") for k, rule in RULES.items()))
    hosts = stored(hosts, "hosts")
    moments = hosts.agg(F.sum("host_docs").alias("n"), F.count(F.lit(1)).alias("hosts"), *(x for k in RULES for x in (F.sum(f"fail_{k}").alias(f"s_{k}"), F.sum(F.col(f"fail_{k}") * F.col(f"fail_{k}") / F.col("host_docs")).alias(f"q_{k}")))).first()
    rates = []
    for k in RULES:
        a, b = beta_prior(moments["n"] or 0, moments["hosts"], moments[f"s_{k}"] or 0, moments[f"q_{k}"] or 0.0)
        rates.append(((F.col(f"fail_{k}") + a) / (F.col("host_docs") + (a + b))).alias(f"rate_{k}"))
    hosts = hosts.select("host", "host_docs", *rates)
    return hosts.withColumn("host_ok", F.greatest(*(F.col(f"rate_{k}") for k in RULES)) <= most)


def beta_prior(n: int, hosts: int, failures: int, squares: float) -> tuple[float, float]:
    """Parameters of the beta prior from: documents, hosts, failures, and the
    sum over hosts of failures squared over documents. Between 1 and 1000
    documents' worth, so that neither a single host nor equal hosts break it."""
    if not n:
        return 0.5, 0.5
    mean = (failures + 0.5) / (n + 1)
    spread = max(squares / n - (failures / n) ** 2, 0.0)  # weighted variance of the hosts' rates
    noise = mean * (1 - mean) * hosts / n  # what chance alone would give
    weight = min(max(mean * (1 - mean) / max(spread - noise, 1e-9) - 1, 1.0), 1000.0)
    return mean * weight, (1 - mean) * weight


def with_verdicts(rows: DataFrame, verdicts: DataFrame, host: str) -> DataFrame:
    """rows with the other columns of `verdicts` for their host; a null host is a host.
    Columns of rows that have such a name are replaced."""
    own = mark([*rows.columns, *verdicts.columns]) + "host"
    verdicts = verdicts.withColumnRenamed("host", own)
    if verdicts.count() <= BROADCAST_HOSTS:
        verdicts = F.broadcast(verdicts)
    new = [c for c in verdicts.columns if c != own]
    kept = [c for c in rows.columns if c.lower() not in {n.lower() for n in new}]
    return rows.join(verdicts, F.col(host).eqNullSafe(F.col(own)), "left").select(*(rows[c] for c in kept), *new)


def keep_good(docs: DataFrame, host: str = "source") -> DataFrame:
    """docs without those that fail a base rule or whose host goes; same columns,
    whatever their names.

    A null or empty text has no words and fails; texts of any length are judged
    whole; of repeated rows all stay or all go; documents without a host share
    the null host; an empty table stays empty. The texts are read twice and never
    shuffled (unless there are more hosts than can be broadcast)."""
    m = mark(docs.columns)
    features, at, ok = m + "features", m + "at", m + "ok"
    scored = with_features(docs, out=features)
    verdicts = host_verdicts(scored, host, features).select("host", F.col("host_ok").alias(ok))
    # the row's number keeps the filter above the features: pushed below, it would repeat their expressions over and over
    held = scored.withColumn(at, F.monotonically_increasing_id())
    good = held.where((F.col(at) >= 0) & ~base_failed(F.col(features))).drop(features, at)
    return with_verdicts(good, verdicts, host).where(F.col(ok)).select(*docs.columns)


def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row for each document, and the verdict of its host. A null text has
    no words and fails the base rules."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    features = stored(with_features(docs).drop("text"), "features")
    f = F.col("features")
    judged = with_verdicts(features, host_verdicts(features, "source"), "source")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *(f[n].alias(n) for n in names), base_failed(f).alias("base_failed"), (~base_failed(f) & F.col("host_ok")).alias("kept"))

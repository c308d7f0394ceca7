"""Result summaries, meta-analysis, scores, prediction and survival (R)."""

from __future__ import annotations

import functools
import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from genoframe.functions import scalars as S
from genoframe.operators.windows import exact_quantiles, global_rank, prune_distance_iter

# Medians of chi-square (one degree) that the three variants divide by.
MEDIAN_SQUARE, MEDIAN_STAT = 0.4549, 0.456

#: Places of a cell in which draws meet donors.
CELL = 64


def inflation(df: DataFrame, p: str = "p") -> DataFrame:
    """Lambda from the root of the median, from the median of roots, and median / 0.456."""
    chi = df.where(F.col(p).isNotNull()).select(F.expr(S.chi2_isf_1(p)).alias("chi2"))
    half = math.sqrt(MEDIAN_SQUARE)
    known = chi.where("chi2 is not null").count()
    # the two middle values: the same ones give the median of the roots
    low, high = exact_quantiles(chi, F.col("chi2"), [(known - 1) // 2 / max(known - 1, 1), known // 2 / max(known - 1, 1)]) if known else (None, None)
    median = F.lit(None if low is None else (low + high) / 2).cast("double")
    root = F.lit(None if low is None else (math.sqrt(low) + math.sqrt(high)) / 2).cast("double")
    return df.sparkSession.range(1).select(F.pow(F.sqrt(median) / half, F.lit(2)).alias("lambda_median"), F.pow(root / half, F.lit(2)).alias("lambda_roots"), (median / MEDIAN_STAT).alias("lambda_stat"))


def correct_inflation(df: DataFrame, lam: float, p: str = "p", beta: str = "beta", sd: str = "sd") -> DataFrame:
    """R2: P, deviation of beta after dividing chi-square by lambda (at least 1)."""
    lam = max(lam, 1.0)
    out = df.withColumn("__c", F.expr(S.chi2_isf_1(p)) / lam)
    return out.withColumns({"p_corrected": F.expr(S.chi2_sf("__c", 1)), "sd_corrected": F.col(sd) * math.sqrt(lam)}).drop("__c")


def sensitivity(alpha_sql: str, wanted_sql: str) -> str:
    """R2: the lambda at which alpha would have to be, as SQL: ratio of the chi-square quantiles."""
    return f"({S.chi2_isf_1(alpha_sql)} / {S.chi2_isf_1(wanted_sql)})"


def summarize_p(ps: DataFrame, markers: DataFrame, n: int, cutoff: float | None = None, tests: int | None = None) -> DataFrame:
    """Results with the map, the N best by P; ``significant`` by a cutoff, or Bonferroni over ``tests``."""
    limit = F.lit(cutoff) if cutoff is not None else F.lit(0.05 / max(1, tests or 1))
    best = ps.where("p is not null").orderBy("p", "marker").limit(n)
    return best.join(markers, "marker", "left").withColumn("significant", F.col("p") < limit).orderBy("p", "marker")


def top_table(ps: DataFrame, n: int, level: float = 0.95) -> DataFrame:
    """The N best rows with confidence limits of every ``beta1.*`` that has its ``sd1.*``."""
    best = ps.orderBy("p", "marker").limit(n)
    limits = {}
    for c in ps.columns:
        if c.startswith("beta1.") and (sd := "sd1." + c[6:]) in ps.columns:
            lo, up = S.sd_to_ci(f"`{c}`", f"`{sd}`", level)
            limits |= {f"ciL.{c[6:]}": F.expr(lo), f"ciU.{c[6:]}": F.expr(up)}
    return best.withColumns(limits)


def manhattan_points(df: DataFrame, cap: float = 15, cutoff: float | None = None) -> DataFrame:
    """Absolute position, -log10 P up to a cap, colour by chromosome parity, or ``hit`` above the cutoff."""
    from genoframe.operators.windows import genome_positions

    rows, _ = genome_positions(df.where("p > 0 and p <= 1"))
    colour = F.when(F.col("chr") % 2 == 1, "odd").otherwise("even")
    if cutoff is not None:
        colour = F.when(F.col("p") < cutoff, "hit").otherwise(colour)
    return rows.select("marker", "chr", "genome_pos", F.least(-F.log10("p"), F.lit(float(cap))).alias("y"), colour.alias("colour"))


def alpha_levels(df: DataFrame, n: int = 40, p: str = "p") -> DataFrame:
    """Share of P below each of n levels: one pass."""
    return df.agg(F.array(*(F.struct(F.lit(k / n).alias("alpha"), F.avg((F.col(p) < k / n).cast("double")).alias("share")) for k in range(1, n + 1))).alias("a")).select(F.explode("a").alias("a")).select("a.*")


def tail_strength(df: DataFrame, p: str = "p", tie: str = "marker") -> DataFrame:
    """Mean of 1 - p_(k) (m + 1) / k."""
    known = df.where(F.col(p).isNotNull()).select(p, tie)
    m = known.agg(F.count("*").alias("m"))
    return global_rank(known, [p, tie], "k").join(F.broadcast(m)).agg(F.avg(1 - F.col(p) * (F.col("m") + 1) / F.col("k")).alias("tail_strength"))


def q_value(df: DataFrame, p: str = "p", tie: str = "marker", lam: float = 0.5) -> DataFrame:
    """q = min over larger P of pi0 m p / k, pi0 from the share of P above ``lam``; null P stays null.

    The running minimum from the end goes over range partitions: minima of partitions, then of the rows after a row within its partition.
    """
    known = df.where(F.col(p).isNotNull())
    stats = known.agg(F.count("*").alias("__m"), F.least(F.avg((F.col(p) > lam).cast("double")) / (1 - lam), F.lit(1.0)).alias("__pi0"))
    ranked = global_rank(known, [p, tie], "__k", part="__block").join(F.broadcast(stats))
    raw = ranked.withColumn("__q", F.col("__pi0") * F.col("__m") * F.col(p) / F.col("__k"))
    mins = raw.groupBy("__block").agg(F.min("__q").alias("__min"))
    after = Window.orderBy(F.desc("__block")).rowsBetween(Window.unboundedPreceding, -1)
    later = mins.select("__block", F.min("__min").over(after).alias("__later"))
    inside = Window.partitionBy("__block").orderBy(F.desc("__k")).rowsBetween(Window.unboundedPreceding, 0)
    out = raw.join(F.broadcast(later), "__block").withColumn("q", F.least(F.min("__q").over(inside), F.coalesce("__later", F.lit(1.0)), F.lit(1.0)))
    return out.select(*df.columns, "q").unionByName(df.where(F.col(p).isNull()).withColumn("q", F.lit(None).cast("double")))


def fisher_p(cols: list[str]) -> Column:
    """Combined P; the even-degree tail is a finite sum."""
    x = " + ".join(f"-2e0 * ln({c})" for c in cols)
    return F.expr(S.chi2_sf(f"({x})", 2 * len(cols)))


def load_study(df: DataFrame, names: dict[str, str], ci: tuple[str, str] | None = None, ids: str = "^rs") -> DataFrame:
    """Standard names, ids that match, deviations from confidence limits."""
    out = df.withColumnsRenamed(names).where(F.col("id").cast("string").rlike(ids))
    return out.withColumn("sd", F.expr(S.ci_to_sd(*ci))) if ci else out


def join_studies(studies: dict[str, DataFrame]) -> DataFrame:
    """Full join by id, columns with the study's name behind them."""
    named = [f.select("id", *(F.col(c).alias(f"{c}.{name}") for c in f.columns if c != "id")) for name, f in studies.items()]
    return functools.reduce(lambda a, b: a.join(b, "id", "full"), named)


def meta(studies: dict[str, DataFrame], maf_eps: float = 0.1) -> DataFrame:
    """Fixed and random effects (DerSimonian-Laird) per id as sums over (id, study) rows; beta turns where maf passes one half by ``maf_eps``."""
    rows = functools.reduce(DataFrame.unionByName, (f.select("id", "maf", "beta", "sd").withColumn("study", F.lit(name)) for name, f in studies.items()))
    turned = F.col("maf") > 0.5 + maf_eps
    rows = rows.where("beta is not null and sd > 0").select("id", "study", F.when(turned, 1 - F.col("maf")).otherwise(F.col("maf")).alias("maf"), F.when(turned, -F.col("beta")).otherwise(F.col("beta")).alias("b"), F.pow("sd", F.lit(-2.0)).alias("w"))
    s = rows.groupBy("id").agg(F.count("*").alias("k"), F.sum("w").alias("w"), F.sum(F.col("w") * F.col("b")).alias("wb"), F.sum(F.col("w") * F.col("b") * F.col("b")).alias("wbb"), F.sum(F.col("w") * F.col("w")).alias("ww"), F.avg("maf").alias("maf_mean"), F.stddev_samp("maf").alias("maf_sd"))
    fixed = s.withColumns({"beta_fixed": F.col("wb") / F.col("w"), "sd_fixed": 1 / F.sqrt("w"), "q": F.greatest(F.col("wbb") - F.col("wb") * F.col("wb") / F.col("w"), F.lit(0.0))})
    tau2 = F.when(F.col("k") > 1, F.greatest((F.col("q") - (F.col("k") - 1)) / (F.col("w") - F.col("ww") / F.col("w")), F.lit(0.0))).otherwise(0.0)
    fixed = fixed.withColumn("tau2", tau2)
    weighted = rows.join(fixed.select("id", "tau2"), "id").withColumn("v", 1 / (1 / F.col("w") + F.col("tau2")))
    random = weighted.groupBy("id").agg((F.sum(F.col("v") * F.col("b")) / F.sum("v")).alias("beta_random"), (1 / F.sqrt(F.sum("v"))).alias("sd_random"))
    out = fixed.join(random, "id").withColumn("p_random", F.expr(S.two_sided("beta_random / sd_random")))
    return out.select("id", "k", "maf_mean", "maf_sd", "beta_fixed", "sd_fixed", "q", "tau2", "beta_random", "sd_random", "p_random")


def meta_origin(studies: dict[str, DataFrame]) -> DataFrame:
    """Where the studies place a marker: (id, chr, pos, allele, warnings).

    ``chr`` and ``pos`` are those of the first study, in their order, that has them; ``allele`` lists the alleles of all studies, ``NA`` where one has none; where studies differ ``warnings`` tells all chromosomes
    (``C: 1:2``) and positions (``P: 10:20``) in this order. Of repeated ids in a study the least values count. Studies may lack any of the columns.
    """
    parts = []
    for k, f in enumerate(studies.values()):
        have = lambda c, kind: (F.min(c) if c in f.columns else F.lit(None)).cast(kind).alias(c)  # noqa: E731, B023
        parts.append(f.groupBy("id").agg(have("chr", "string"), have("pos", "long"), have("allele", "string")).withColumn("k", F.lit(k)))
    rows = functools.reduce(DataFrame.unionByName, parts)
    # an entry for each study at most
    told = rows.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("k", "chr", "pos", "allele"))).alias("s"))
    seen = lambda c: F.array_distinct(F.filter(F.transform("s", lambda x: x[c].cast("string")), lambda v: v.isNotNull()))
    alleles = F.map_from_entries(F.transform("s", lambda x: F.struct(x["k"], x["allele"])))
    listed = [F.coalesce(F.element_at(alleles, k), F.lit("NA")) for k in range(len(studies))]
    warn = lambda tag, c: F.when(F.size(c) > 1, F.concat(F.lit(f"{tag}: "), F.array_join(c, ":")))
    out = told.select("id", seen("chr").alias("cs"), seen("pos").alias("ps"), F.concat_ws(":", *listed).alias("allele"))
    text = F.nullif(F.concat_ws(", ", warn("C", F.col("cs")), warn("P", F.col("ps"))), F.lit(""))
    return out.select("id", F.get("cs", F.lit(0)).alias("chr"), F.get("ps", F.lit(0)).cast("long").alias("pos"), "allele", text.alias("warnings"))


def meta_reml(studies: dict[str, DataFrame], steps: int = 60) -> DataFrame:
    """R12 by restricted maximum likelihood: the few (study) values of an id become one array; the fixed-point iteration is vectorised over ids."""
    rows = functools.reduce(DataFrame.unionByName, (f.select("id", "beta", "sd") for f in studies.values())).where("beta is not null and sd > 0")
    arrays = rows.groupBy("id").agg(F.collect_list(F.struct("beta", "sd")).alias("x"))

    def run(batches):
        for pdf in batches:
            out = []
            for key, x in zip(pdf["id"], pdf["x"], strict=True):
                b, v = np.array([r["beta"] for r in x]), np.array([r["sd"] for r in x]) ** 2
                tau = max(0.0, float(b.var(ddof=1) - v.mean())) if len(b) > 1 else 0.0
                for _ in range(steps if len(b) > 1 else 0):
                    w = 1 / (v + tau)
                    mean = (w * b).sum() / w.sum()
                    new = max(0.0, float((w * w * ((b - mean) ** 2 - v)).sum() / (w * w).sum() + 1 / w.sum()))
                    if abs(new - tau) < 1e-12:
                        break
                    tau = new
                w = 1 / (v + tau)
                out.append((key, (w * b).sum() / w.sum(), w.sum() ** -0.5, tau))
            yield pd.DataFrame(out, columns=["id", "beta", "sd", "tau2"])

    return arrays.mapInPandas(run, "id long, beta double, sd double, tau2 double")


def prs_snps(df: DataFrame, p: float = 0.01, d: int = 1_000_000) -> DataFrame:
    """R14"""
    return prune_distance_iter(df.where(F.col("p") < p), d)


def prs_score(dosage: DataFrame, weights: DataFrame, intercept: float = 0.0, response: bool = False) -> DataFrame:
    """Linear predictor over dosages (iid, marker, dosage) and weights (marker, beta); on the response scale by expit."""
    eta = dosage.join(weights.select("marker", "beta"), "marker").groupBy("iid").agg((F.sum(F.col("beta") * F.col("dosage")) + intercept).alias("score"))
    return eta.withColumn("score", F.expr(S.expit("score"))) if response else eta


def fold_of(key: str, k: int, seed: int = 1, sql: bool = False) -> Column:
    """Fold 0..k-1 of an id or cluster."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(k)).cast("int")


def class_folds(df: DataFrame, key: str, label: str, k: int = 15, least: int = 3, seed: int = 1) -> DataFrame:
    """(key, label, fold) for classification: the rows of each class, in an order by hash, are dealt round robin over the folds, and each class goes on where the one before it ended.

    So folds and the classes within them differ by one at most, which leaves every training part (all folds but one) as many of a class as can be. If that is fewer than ``least`` of some class, there is no such partition, and it is an
    error. Rows without a label are left out.
    """
    known = df.where(F.col(label).isNotNull()).select(key, label)
    short = known.groupBy(label).agg(F.count("*").alias("n")).where(F.col("n") - F.ceil(F.col("n") / k) < least).limit(5).collect()
    if short:
        raise ValueError(f"fewer than {least} in some training part: {', '.join(f'{r[label]} ({r.n})' for r in short)}")
    ranked = global_rank(known.withColumn("__h", F.xxhash64(F.lit(seed), key)), [label, "__h", key], "__at")
    return ranked.select(key, label, ((F.col("__at") - 1) % k).cast("int").alias("fold"))


def _assembled(df: DataFrame, xs: list[str], label: str) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=xs, outputCol="features").transform(df.dropna(subset=[*xs, label]).withColumn("label", F.col(label).cast("double")))


def prs_fit(train: DataFrame, test: DataFrame, label: str, xs: list[str], penalty: float = 0.0, mix: float = 1.0, binary: bool = True):
    """(model, predictions of ``test`` clamped to [0, 1] for a binary label)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import LinearRegression

    kind = LogisticRegression if binary else LinearRegression
    model = kind(regParam=penalty, elasticNetParam=mix, maxIter=100).fit(_assembled(train, xs, label))
    out = model.transform(_assembled(test, xs, label))
    value = vector_to_array("probability")[1] if binary else F.col("prediction")
    return model, out.withColumn("predicted", F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)) if binary else value).drop("features", "rawPrediction", "probability", "prediction")


def cross_validate(df: DataFrame, key: str, label: str, xs: list[str], k: int = 5, penalty: float = 0.0, seed: int = 1, binary: bool = True, least: int | None = None) -> DataFrame:
    """Predictions of each row by the model that did not see its fold. Folds are random, or with ``least`` dealt by class (``class_folds``)."""
    folded = df.withColumn("fold", fold_of(key, k, seed)) if least is None else df.join(class_folds(df, key, label, k, least, seed).select(key, "fold"), key)
    parts = [prs_fit(folded.where(F.col("fold") != i), folded.where(F.col("fold") == i), label, xs, penalty, binary=binary)[1] for i in range(k)]
    return functools.reduce(DataFrame.unionByName, parts)


def refit(df: DataFrame, label: str, xs: list[str], penalties: list[float], cutoff: float = 1e-8, binary: bool = True) -> DataFrame:
    """For each penalty the chosen variables and their unpenalised coefficients."""
    rows = []
    for penalty in penalties:
        model, _ = prs_fit(df, df.limit(0), label, xs, penalty, binary=binary)
        chosen = [x for x, b in zip(xs, model.coefficients.toArray(), strict=True) if abs(b) > cutoff]
        if chosen:
            again, _ = prs_fit(df, df.limit(0), label, chosen, 0.0, binary=binary)
            rows += [(float(penalty), x, float(b)) for x, b in zip(chosen, again.coefficients.toArray(), strict=True)]
    return df.sparkSession.createDataFrame(rows, "penalty double, variable string, coefficient double")


def roc(df: DataFrame, prob: str, label: str) -> DataFrame:
    """At each cutoff (predicted if score >= cutoff) counts, rates and the class shares ``tp`` and ``tn``: sums by distinct score, cumulated."""
    by = df.where(F.col(prob).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(prob).alias("cutoff")).agg(F.sum(F.col(label).cast("long")).alias("pos"), F.count("*").alias("n"))
    total = by.agg(F.sum("pos").alias("all_pos"), F.sum(F.col("n") - F.col("pos")).alias("all_neg"))
    up = _cumulated(by, ["cutoff"], ["pos", "n"])
    j = up.join(F.broadcast(total))
    below_pos, below_neg = F.col("cum_pos") - F.col("pos"), F.col("cum_n") - F.col("n") - F.col("cum_pos") + F.col("pos")
    return j.select("cutoff", ((F.col("all_pos") - below_pos) / F.col("all_pos")).alias("tp"), (below_neg / F.col("all_neg")).alias("tn"), ((F.col("all_neg") - below_neg) / F.col("all_neg")).alias("fpr"))


def _cumulated(df: DataFrame, order: list, cols: list[str]) -> DataFrame:
    """Row numbers ``k`` (from 1) by ``order`` and running sums: within range partitions, plus the sums of the partitions before (a row for each partition)."""
    b = global_rank(df, order, "k", part="__b")
    sums = b.groupBy("__b").agg(*(F.sum(c).alias(f"__s_{c}") for c in cols))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("__b", *(F.coalesce(F.sum(f"__s_{c}").over(before), F.lit(0)).alias(f"__o_{c}") for c in cols))
    inside = Window.partitionBy("__b").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    out = b.join(F.broadcast(offsets), "__b").withColumns({f"cum_{c}": F.col(f"__o_{c}") + F.sum(c).over(inside) for c in cols})
    return out.drop("__b", *(f"__o_{c}" for c in cols))


def auc(df: DataFrame, prob: str, label: str, level: float = 0.95) -> DataFrame:
    """Rank AUC (ties one half) with confidence limits (Hanley and McNeil)."""
    by = df.where(F.col(prob).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(prob).alias("s")).agg(F.sum(F.col(label).cast("long")).alias("pos"), F.count("*").alias("n"))
    up = _cumulated(by, ["s"], ["n"])
    s = up.agg(F.sum(F.col("pos") * (F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2)).alias("ranks"), F.sum("pos").alias("P"), F.sum(F.col("n") - F.col("pos")).alias("N"))
    a = s.withColumn("auc", (F.col("ranks") - F.col("P") * (F.col("P") + 1) / 2) / (F.col("P") * F.col("N")))
    q1, q2 = F.col("auc") / (2 - F.col("auc")), 2 * F.col("auc") * F.col("auc") / (1 + F.col("auc"))
    var = (F.col("auc") * (1 - F.col("auc")) + (F.col("P") - 1) * (q1 - F.col("auc") * F.col("auc")) + (F.col("N") - 1) * (q2 - F.col("auc") * F.col("auc"))) / (F.col("P") * F.col("N"))
    a = a.withColumn("sd", F.sqrt(var))
    lo, up_ = S.sd_to_ci("auc", "sd", level)
    return a.select("auc", "sd", F.expr(lo).alias("lo"), F.expr(up_).alias("up"))


def calibrate(df: DataFrame, prob: str, label: str, n: int = 5) -> DataFrame:
    """R20"""
    from genoframe.operators.windows import quantile_bins

    return quantile_bins(df, prob, n).groupBy("bin").agg(F.avg(label).alias("truth"), F.avg(prob).alias("prediction"), F.count("*").alias("n"))


def kaplan_meier(df: DataFrame, time: str, event: str, strata: str) -> DataFrame:
    """At risk, events and survival at each time of each stratum; rows are first counted by time."""
    by = df.groupBy(strata, F.col(time).alias("time")).agg(F.sum(F.col(event).cast("long")).alias("events"), F.count("*").alias("n"))
    down = Window.partitionBy(strata).orderBy(F.desc("time")).rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy(strata).orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    risk = by.withColumn("at_risk", F.sum("n").over(down))
    # where everyone at risk fails the curve is 0 from there on
    log = F.when(F.col("events") < F.col("at_risk"), F.log1p(-F.col("events") / F.col("at_risk")))
    dead = F.max((F.col("events") == F.col("at_risk")).cast("int")).over(up)
    return risk.withColumn("survival", F.when(dead == 1, 0.0).otherwise(F.exp(F.sum(log).over(up)))).select(strata, "time", "at_risk", "events", "survival")


def log_rank(df: DataFrame, time: str, event: str, group: str) -> DataFrame:
    """Chi-square of the log-rank test of two groups (0 and 1)."""
    by = df.groupBy(F.col(time).alias("time")).agg(F.sum(F.col(event).cast("long")).alias("d"), F.count("*").alias("n"), F.sum(F.when(F.col(group) == 1, F.col(event)).otherwise(0).cast("long")).alias("d1"), F.count_if(F.col(group) == 1).alias("n1"))
    r = _cumulated(by, [F.desc("time")], ["n", "n1"])
    e = F.col("d") * F.col("cum_n1") / F.col("cum_n")
    v = F.when(F.col("cum_n") > 1, F.col("d") * (F.col("cum_n1") / F.col("cum_n")) * (1 - F.col("cum_n1") / F.col("cum_n")) * (F.col("cum_n") - F.col("d")) / (F.col("cum_n") - 1)).otherwise(0.0)
    s = r.agg(F.sum("d1").alias("observed"), F.sum(e).alias("expected"), F.sum(v).alias("variance"))
    s = s.withColumn("chi2", F.pow(F.col("observed") - F.col("expected"), F.lit(2)) / F.col("variance"))
    return s.withColumn("p", F.expr(S.chi2_sf("chi2", 1)))


def surv_table(km: DataFrame, strata: str) -> DataFrame:
    """Median (first time with survival of at most one half) and restricted mean."""
    along = Window.partitionBy(strata).orderBy("time")
    area = F.coalesce(F.lag("survival").over(along), F.lit(1.0)) * (F.col("time") - F.coalesce(F.lag("time").over(along), F.lit(0)))
    return km.withColumn("area", area).groupBy(strata).agg(F.min(F.when(F.col("survival") <= 0.5, F.col("time"))).alias("median"), F.sum("area").alias("mean"))


def impute_value(df: DataFrame, col: str) -> DataFrame:
    """Nulls become the mean."""
    mean = df.agg(F.avg(col).alias("__m"))
    return df.join(F.broadcast(mean)).withColumn(col, F.coalesce(col, "__m")).drop("__m")


def impute_draw(df: DataFrame, col: str, key: str, n: int = 1, seed: int = 1) -> DataFrame:
    """N copies, nulls filled by seeded draws of observed values."""
    known = global_rank(df.where(F.col(col).isNotNull()).select(key, F.col(col).alias("__v")), [key], "__at").select("__at", "__v")
    count = known.agg(F.count("*").alias("__n"))
    copies = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(n)))).join(F.broadcast(count))
    at = F.when(F.col(col).isNull() & (F.col("__n") > 0), F.pmod(F.xxhash64(F.lit(seed), F.col("copy"), F.col(key)), F.col("__n")) + 1)
    return copies.withColumn("__at", at).join(known, "__at", "left").withColumn(col, F.coalesce(col, "__v")).drop("__at", "__v", "__n")


def impute_cross(df: DataFrame, donors: DataFrame, cols: list[str], key: str, seed: int = 1) -> DataFrame:
    """Nulls of the columns filled by seeded draws, with replacement, from the observed values of the same columns in another data set; a column without donors keeps its nulls.

    The observed values of all columns are numbered at once, in the order of their text, so that draws do not depend on partitions. ``key`` tells the rows of ``df`` apart.
    """
    if not cols:
        return df
    types = dict(df.dtypes)
    long = donors.select(*(F.col(c).cast(types[c]).cast("string").alias(c) for c in cols)).unpivot([], cols, "__c", "__v").where("__v is not null")
    counted = long.groupBy("__c", "__v").agg(F.count("*").alias("__w"))
    # equal values are one row with as many places as copies
    placed = _cumulated(counted, ["__c", "__v"], ["__w"])
    ends = placed.groupBy("__c").agg(F.min(F.col("cum___w") - F.col("__w")).alias("__first"), F.sum("__w").alias("__n"))  # one row a column
    index = placed.join(F.broadcast(ends), "__c").select("__c", "__v", (F.col("cum___w") - F.col("__w") - F.col("__first")).alias("__lo"), (F.col("cum___w") - F.col("__first")).alias("__hi"))
    gaps = df.select(key, F.explode(F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in cols)))).alias("__c")).join(F.broadcast(ends), "__c")
    drawn = gaps.withColumn("__at", F.pmod(F.xxhash64(F.lit(seed), "__c", key), F.col("__n"))).select(key, "__c", "__at")
    # places are met by cells; a value with many copies is in each of its cells
    cells = index.withColumn("__cell", F.explode(F.sequence(F.floor(F.col("__lo") / CELL), F.floor((F.col("__hi") - 1) / CELL))))
    met = drawn.withColumn("__cell", F.floor(F.col("__at") / CELL)).join(cells, ["__c", "__cell"]).where("__lo <= __at and __at < __hi")
    filled = met.groupBy(key).agg(*(F.max(F.when(F.col("__c") == c, F.col("__v"))).cast(types[c]).alias(f"__{c}") for c in cols))
    out = df.join(filled, key, "left")
    return out.withColumns({c: F.coalesce(c, f"__{c}") for c in cols}).select(*df.columns)


def compare_samples(df: DataFrame, x: str, group: str) -> DataFrame:
    """Welch's t with its degrees of freedom, and Wilcoxon's rank sum (normal approximation with ties) of groups 0 and 1."""
    known = df.where(F.col(x).isNotNull() & F.col(group).isin(0, 1))
    side = lambda g: F.when(F.col(group) == g, F.col(x).cast("double"))
    m = known.agg(*(f(side(g)).alias(f"{n}{g}") for g in (0, 1) for n, f in (("n", F.count), ("m", F.avg), ("v", F.var_samp))))
    e0, e1 = F.col("v0") / F.col("n0"), F.col("v1") / F.col("n1")
    m = m.withColumns({"t": (F.col("m1") - F.col("m0")) / F.sqrt(e0 + e1), "df": F.pow(e0 + e1, F.lit(2)) / (e0 * e0 / (F.col("n0") - 1) + e1 * e1 / (F.col("n1") - 1))})
    by = known.groupBy(F.col(x).alias("s")).agg(F.count_if(F.col(group) == 1).alias("pos"), F.count("*").alias("n"))
    up = _cumulated(by, ["s"], ["n"])
    w = up.agg(F.sum(F.col("pos") * (F.col("cum_n") - F.col("n") + (F.col("n") + 1) / 2)).alias("rank_sum"), F.sum(F.pow("n", F.lit(3)) - F.col("n")).alias("ties"))
    j = m.join(w)
    n = F.col("n0") + F.col("n1")
    u = F.col("rank_sum") - F.col("n1") * (F.col("n1") + 1) / 2
    sd = F.sqrt(F.col("n0") * F.col("n1") / 12.0 * (n + 1 - F.col("ties") / (n * (n - 1))))
    j = j.withColumns({"u": u, "z": (u - F.col("n0") * F.col("n1") / 2) / sd})
    return j.withColumn("p_wilcoxon", F.expr(S.two_sided("z"))).select("n0", "n1", "m0", "m1", "t", "df", "u", "z", "p_wilcoxon")


def histogram(df: DataFrame, x: str, bins: int, group: str | None = None, relative: bool = False) -> DataFrame:
    """Counts of equal bins over the range of all rows."""
    ends = df.agg(F.min(x).alias("__lo"), F.max(x).alias("__hi"))
    place = F.least(F.floor((F.col(x) - F.col("__lo")) / F.nullif(F.col("__hi") - F.col("__lo"), F.lit(0)) * bins), F.lit(bins - 1))
    keys = [group] if group else []
    out = df.where(F.col(x).isNotNull()).join(F.broadcast(ends)).withColumn("bin", F.coalesce(place, F.lit(0)).cast("long")).groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    return out.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(*keys))) if relative else out


def export_consortium(assoc: DataFrame, qc: DataFrame) -> tuple[DataFrame, DataFrame]:
    """SC24: (19 hand-over columns, monomorphic markers): left look-up of the quality columns with ``.`` and 1 for what is not matched."""
    j = assoc.join(qc, ["chr", "pos"], "left")
    c = lambda name, default: F.coalesce(F.col(name).cast("string"), F.lit(default))
    rows = j.select(
        F.col("marker").alias("SNP"), F.lit("+").alias("STRAND"), F.lit("37").alias("BUILD"), F.col("chr").alias("CHR"), F.col("pos").alias("POS"), F.col("a1").alias("EFFECT_ALLELE"), F.col("a0").alias("NON_EFFECT_ALLELE"), F.col("n").alias("N"),
        c("n0", ".").alias("N0"), c("n1", ".").alias("N1"), c("n2", ".").alias("N2"), F.col("af").alias("EAF"), c("p_hwe", "1").alias("HWE_P"), c("call_rate", "1").alias("CALL_RATE"), F.col("beta").alias("BETA"), F.col("sd").alias("SE"), F.col("p").alias("PVAL"), F.when(F.col("info").isNull(), 0).otherwise(1).alias("IMPUTED"), F.col("info").alias("INFO"),
    )
    mono = (F.col("EAF") <= 0) | (F.col("EAF") >= 1)
    return rows.where(~mono), rows.where(mono)

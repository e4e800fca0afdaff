"""Predictive and prescriptive operators (PRD-*).

Features are computed strictly from data at or before the snapshot date (no
leakage). The two learned models use MLlib (``LogisticRegression``,
``KMeans``, fixed seeds); the rule-based churn risk score is their
oracle-checkable twin. Everything else is aggregate arithmetic.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c, dbl, money, money_list, ratio
from ..functions.ordering import quantiles_together, with_rows_before
from ..session import scratch_table
from . import derive as D


def _d(x):
    return F.lit(x).cast("date")


def active_owners_on(t, day: str) -> DataFrame:
    """Owners with a subscription covering the day before ``day`` (start < day <= end or open)."""
    s = D.subscription_facts(t)
    return (s.filter((c("start_date") < _d(day)) & (c("end_date").isNull() | (c("end_date") >= _d(day))))
            .select("owner_id", "owner_type").distinct())


# ----------------------------------------------------------------------- PRD-1
def churn_features(t, snapshot: str) -> DataFrame:
    """PRD-1: one row per owner active at ``snapshot`` with behaviour up to it."""
    snap = _d(snapshot)
    owners = active_owners_on(t, snapshot)
    since = lambda days: F.date_sub(snap, days)
    recent = lambda at: (F.to_date(at) < snap) & (F.to_date(at) >= since(90))
    subs = D.subscription_facts(t).select("subscription_id", "owner_id")
    none = F.lit(None).cast("date")

    def facts(rows, owner="owner_id", day=none, **values):
        return rows.select(c(owner).alias("owner_id"), day.alias("day"), *[
            values.get(x, F.lit(0)).cast("bigint").alias(x) for x in ("sessions", "failed", "cases", "cancels")])

    # what a subscription brings meets its owner in one join, and one partial aggregate per owner sums all windows
    of_subs = (t.payments.filter((c("payment_status") == "failed") & recent("payment_attempted_at"))
               .select("subscription_id", F.lit(1).alias("failed"), F.lit(0).alias("cancels"))
               .unionByName(t.subscription_events.filter((c("event_type") == "cancellation_requested") & recent("event_at"))
                            .select("subscription_id", F.lit(0).alias("failed"), F.lit(1).alias("cancels")))
               .join(subs, "subscription_id"))
    sums = reduce(DataFrame.unionByName, [
        facts(t.customer_engagement.filter(c("engagement_date") < snap), "customer_id", c("engagement_date"),
              sessions=c("sessions_count")),
        facts(of_subs, failed=c("failed"), cancels=c("cancels")),
        facts(t.support_interactions.filter(recent("interaction_at")), "customer_id", cases=F.lit(1)),
    ]).groupBy("owner_id").agg(
        F.max("day").alias("last_active"),
        F.sum(F.when(c("day") >= since(30), c("sessions"))).alias("sessions_30d"),
        F.sum(F.when(c("day") >= since(60), c("sessions"))).alias("sessions_60d"),
        F.sum("failed").alias("failed_payments_90d"), F.sum("cases").alias("support_cases_90d"),
        F.max(F.when(c("cancels") > 0, 1)).alias("cancel_intent"))
    tenure = D.owner_tenure(t, snapshot).select("owner_id", "tenure_days")
    latest = (D.subscription_facts(t).filter(c("start_date") < snap).groupBy("owner_id")
              .agg(F.max_by(F.struct("billing_frequency", "product_name"), F.struct("start_date", "subscription_id"))
                   .alias("plan")))
    chan = D.attribution(t).select(c("customer_id").alias("owner_id"), "channel")
    j = reduce(lambda a, b: a.join(b, "owner_id", "left"), [sums, tenure, latest, chan], owners)
    return j.select(
        "owner_id", "owner_type",
        F.datediff(snap, c("last_active")).cast("int").alias("days_since_active"),
        F.coalesce(c("sessions_30d"), F.lit(0)).cast("bigint").alias("sessions_30d"),
        (F.coalesce(c("sessions_60d"), F.lit(0)) - F.coalesce(c("sessions_30d"), F.lit(0))).cast("bigint")
        .alias("sessions_prev_30d"),
        F.coalesce(c("failed_payments_90d"), F.lit(0)).cast("bigint").alias("failed_payments_90d"),
        F.coalesce(c("support_cases_90d"), F.lit(0)).cast("bigint").alias("support_cases_90d"),
        F.coalesce(c("cancel_intent"), F.lit(0)).cast("int").alias("cancel_intent"),
        F.coalesce(c("tenure_days"), F.lit(0)).cast("bigint").alias("tenure_days"),
        c("plan.billing_frequency").alias("billing_frequency"), c("plan.product_name").alias("product_name"),
        F.coalesce(c("channel"), F.when(c("owner_type") == "organisation", "Organisation")
                   .otherwise("Unattributed")).alias("channel"),
    )


# ----------------------------------------------------------------------- PRD-2
def churn_labels(t, snapshot: str, horizon: int = 30) -> DataFrame:
    """PRD-2: 1 when an owner active at ``snapshot`` churns (DER-3) within (snapshot, snapshot + horizon]."""
    snap = _d(snapshot)
    ch = (D.churn_events(t).filter((c("churn_date") > snap) & (c("churn_date") <= F.date_add(snap, horizon)))
          .select("owner_id").distinct().withColumn("hit", F.lit(1)))
    return (active_owners_on(t, snapshot).join(ch, "owner_id", "left")
            .select("owner_id", "owner_type", F.coalesce(c("hit"), F.lit(0)).cast("int").alias("label")))


# ----------------------------------------------------------------------- PRD-3 / PRD-6
NUMERIC_FEATURES = ["sessions_30d", "sessions_prev_30d", "failed_payments_90d", "support_cases_90d", "cancel_intent",
                    "tenure_days"]
CATEGORICAL_FEATURES = ["billing_frequency", "owner_type"]


def _model_frame(features: DataFrame) -> DataFrame:
    return features.select(
        "owner_id", *[c(x).cast("double").alias(x) for x in NUMERIC_FEATURES],
        F.coalesce(c("days_since_active"), F.lit(9999)).cast("double").alias("days_since_active"),
        *[F.coalesce(c(x), F.lit("none")).alias(x) for x in CATEGORICAL_FEATURES])


def _fit_score(train: DataFrame, score: DataFrame, label_col: str = "label") -> DataFrame:
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler

    idx = [StringIndexer(inputCol=x, outputCol=f"{x}_ix", handleInvalid="keep") for x in CATEGORICAL_FEATURES]
    ohe = OneHotEncoder(inputCols=[f"{x}_ix" for x in CATEGORICAL_FEATURES],
                        outputCols=[f"{x}_oh" for x in CATEGORICAL_FEATURES], handleInvalid="keep")
    vec = VectorAssembler(inputCols=NUMERIC_FEATURES + ["days_since_active"] +
                          [f"{x}_oh" for x in CATEGORICAL_FEATURES], outputCol="raw")
    scale = StandardScaler(inputCol="raw", outputCol="features")
    lr = LogisticRegression(featuresCol="features", labelCol=label_col, maxIter=50, regParam=0.01)
    model = Pipeline(stages=[*idx, ohe, vec, scale, lr]).fit(train)
    from pyspark.ml.functions import vector_to_array
    return model.transform(score).select("owner_id", vector_to_array("probability")[1].alias("probability"))


def _snapshots(t, train_at: str | None, score_at: str | None, gap_months: int = 6, back_months: int = 2):
    """Snapshot days: unless given, scoring two months before ``as_of`` (so that its horizon has passed) and
    training ``gap_months`` earlier, both at a month's first day."""
    y, m = int(t.as_of[:4]), int(t.as_of[5:7])

    def first_day(months_back):
        n = y * 12 + m - 1 - months_back
        return f"{n // 12:04d}-{n % 12 + 1:02d}-01"

    return train_at or first_day(back_months + gap_months), score_at or first_day(back_months)


def _churn_scores(t, train_at: str, score_at: str, horizon: int) -> DataFrame:
    train = (_model_frame(churn_features(t, train_at))
             .join(churn_labels(t, train_at, horizon).select("owner_id", c("label").cast("double")), "owner_id"))
    return _fit_score(scratch_table(train, "train"), _model_frame(churn_features(t, score_at)))  # read by every fitted stage


def churn_model(t, train_at: str | None = None, score_at: str | None = None, horizon: int = 30) -> DataFrame:
    """PRD-3: logistic churn model trained on an earlier snapshot, scoring owners at a later one."""
    scores = _churn_scores(t, *_snapshots(t, train_at, score_at), horizon)
    return scores.withColumn("probability", dbl(c("probability")))


def churn_model_auc(t, train_at: str | None = None, score_at: str | None = None, horizon: int = 30) -> DataFrame:
    """PRD-3: AUC of the model on the scoring snapshot's realised labels (one row)."""
    train_at, score_at = _snapshots(t, train_at, score_at)
    p = _churn_scores(t, train_at, score_at, horizon)
    y = churn_labels(t, score_at, horizon).select("owner_id", "label")
    j = p.join(y, "owner_id")
    # rank-based AUC (Mann-Whitney) on the unrounded scores; ties get the average rank
    r = j.groupBy("probability").agg(F.count("*").alias("n"), F.sum("label").alias("pos"))
    r = with_rows_before(r, "probability", "n")
    r = r.withColumn("avg_rank", c("before") + (c("n") + 1) / 2.0)
    tot = r.agg(F.sum(c("avg_rank") * c("pos")).alias("rank_sum"), F.sum("pos").alias("P"), F.sum("n").alias("N"))
    return tot.select(c("P").cast("bigint").alias("positives"), (c("N") - c("P")).cast("bigint").alias("negatives"),
                      dbl((c("rank_sum") - c("P") * (c("P") + 1) / 2) / (c("P") * (c("N") - c("P"))), 4).alias("auc"))


def upgrade_propensity(t, train_at: str | None = None, score_at: str | None = None, horizon: int = 90) -> DataFrame:
    """PRD-6: probability of an upgrade within ``horizon`` days, same features as churn."""
    from .migration import plan_moves
    train_at, score_at = _snapshots(t, train_at, score_at, gap_months=11)

    def labels(at):
        up = (plan_moves(t).filter((c("product_move") == "upgrade") & (c("move_date") > _d(at))
                                   & (c("move_date") <= F.date_add(_d(at), horizon)))
              .select("owner_id").distinct().withColumn("label", F.lit(1.0)))
        return active_owners_on(t, at).join(up, "owner_id", "left").select(
            "owner_id", F.coalesce(c("label"), F.lit(0.0)).alias("label"))

    train = _model_frame(churn_features(t, train_at)).join(labels(train_at), "owner_id")
    return _fit_score(scratch_table(train, "train"), _model_frame(churn_features(t, score_at))).withColumn(
        "probability", dbl(c("probability")))


def score_summary(scores: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """One row: rows, distinct owners and rows whose ``col`` lies in [lo, hi]."""
    return scores.agg(F.count("*").alias("rows"), F.countDistinct("owner_id").alias("owners"),
                      F.count_if(c(col).between(lo, hi)).alias("in_range"))


# ----------------------------------------------------------------------- PRD-4
# Fixed points of the rule-based risk score (our choice; the docs ask for a risk score only).
RISK_POINTS = {
    "inactive_14d": 20, "session_drop": 15, "failed_payment": 10, "failed_payment_cap": 30,
    "support_case": 5, "support_case_cap": 15, "cancel_intent": 25, "new_customer": 10,
}


def churn_risk_score(t, as_of: str | None = None) -> DataFrame:
    """PRD-4: additive 0-100 churn risk for owners active at ``as_of`` with a band."""
    f = churn_features(t, as_of or t.as_of)
    p = RISK_POINTS
    score = (
        F.when(c("days_since_active").isNull() | (c("days_since_active") > 14), p["inactive_14d"]).otherwise(0)
        + F.when(c("sessions_30d") * 2 < c("sessions_prev_30d"), p["session_drop"]).otherwise(0)
        + F.least(c("failed_payments_90d") * p["failed_payment"], F.lit(p["failed_payment_cap"]))
        + F.least(c("support_cases_90d") * p["support_case"], F.lit(p["support_case_cap"]))
        + c("cancel_intent") * p["cancel_intent"]
        + F.when(c("tenure_days") < 90, p["new_customer"]).otherwise(0)
    )
    return (f.select("owner_id", "owner_type", F.least(score, F.lit(100)).cast("int").alias("risk_score"))
            .withColumn("risk_band", F.when(c("risk_score") >= 60, "high").when(c("risk_score") >= 30, "medium")
                        .otherwise("low")))


# ----------------------------------------------------------------------- PRD-5
def _series_revenue(t, as_of=None, cells: DataFrame | None = None) -> DataFrame:
    if cells is not None:
        by = cells.filter(c("payments") > 0).select("month", *SERIES, "revenue")
    else:
        r = D.revenue_facts(t).filter(c("paid_at") < _d(as_of or t.as_of).cast("timestamp_ntz"))
        by = r.groupBy("month", *SERIES).agg(F.sum("amount").alias("revenue"))
    total = by.groupBy("month", "currency").agg(F.sum("revenue").alias("revenue")).select(
        "month", "currency", F.lit("ALL").alias("product_name"), F.lit("ALL").alias("billing_frequency"), "revenue")
    return by.unionByName(total)


def revenue_forecast(t, months: int = 3, as_of: str | None = None, cells: DataFrame | None = None) -> DataFrame:
    """PRD-5: linear-trend forecast of monthly revenue for the next ``months`` months per currency,
    product x frequency and in total (least squares on the month index, one aggregate per series),
    from payments before ``as_of`` (``cells``: ``derive.revenue_cells`` of the same day)."""
    s = _series_revenue(t, as_of, cells).withColumn(
        "x", (F.year("month") * 12 + F.month("month")).cast("double"))
    fit = s.groupBy("currency", "product_name", "billing_frequency").agg(
        F.regr_slope(c("revenue").cast("double"), c("x")).alias("slope"),
        F.regr_intercept(c("revenue").cast("double"), c("x")).alias("intercept"),
        F.count("*").alias("points"))
    last_month = s.agg(F.max("month")).scalar()
    steps = F.explode(F.sequence(F.lit(1), F.lit(months))).alias("h")
    out = fit.select("*", steps).withColumn("month", F.add_months(last_month, c("h")))
    x = (F.year("month") * 12 + F.month("month")).cast("double")
    return out.select("currency", "product_name", "billing_frequency", "month", c("h").cast("int").alias("horizon"),
                      c("points").cast("bigint").alias("points"),
                      dbl(F.greatest(c("intercept") + c("slope") * x, F.lit(0.0)), 2).alias("forecast_revenue"))


SERIES = ("currency", "product_name", "billing_frequency")
BACKTEST_MONTHS = 6       # origins of the backtest: the last months of the history
LEAST_HISTORY = 12        # months before an origin that the seasonal models need
MODELS = ("linear", "index", "naive")  # a tie goes to the earlier one


def _spine(t, as_of=None) -> DataFrame:
    """Revenue per series and month without gaps: from the series' first month to the last complete month of all,
    0 where nothing was paid. ``x`` counts months."""
    end = F.add_months(F.trunc(_d(as_of or t.as_of), "month"), -1)
    s = _series_revenue(t, as_of).where(c("month") <= end)
    first = s.groupBy(*SERIES).agg(F.min("month").alias("first"))
    months = first.select(*SERIES, F.explode(F.sequence("first", end, F.expr("interval 1 month"))).alias("month"))
    return (months.join(s, [*SERIES, "month"], "left")
            .select(*SERIES, "month", F.coalesce(c("revenue").cast("double"), F.lit(0.0)).alias("y"),
                    (F.year("month") * 12 + F.month("month")).alias("x")))


def _models_at(spine: DataFrame, origins: Column, months: int) -> DataFrame:
    """One row per series, origin and horizon with each model's figure from the months up to the origin.

    linear: least squares on the month; index: mean of the last twelve months times the calendar month's mean over
    the mean of all months; naive: the same month a year before. The seasonal ones are NULL with less than
    LEAST_HISTORY months. All models come from one aggregate; a group holds a series' months."""
    at = spine.select("*", F.explode(origins).alias("origin")).where(c("x") <= c("origin"))
    target = lambda h: c("origin") + h
    y, x = c("y"), c("x").cast("double")
    cols = []
    for h in range(1, months + 1):
        same = (c("x") % 12) == (target(h) % 12)
        cols += [F.avg(F.when(same, y)).alias(f"season{h}"), F.max(F.when(c("x") == target(h) - 12, y)).alias(f"naive{h}")]
    fit = at.groupBy(*SERIES, "origin").agg(
        F.count("*").alias("points"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.avg(y).alias("mean"), F.avg(F.when(c("x") > c("origin") - 12, y)).alias("level"), *cols)
    long = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), c(f"season{h}").alias("season"),
                                        c(f"naive{h}").alias("naive")) for h in range(1, months + 1)])).alias("f")
    enough = c("points") >= LEAST_HISTORY
    line = F.coalesce(c("intercept") + c("slope") * (c("origin") + c("f.horizon")), c("mean"))
    return fit.select("*", long).select(
        *SERIES, "origin", c("f.horizon").alias("horizon"), "points", F.greatest(line, F.lit(0.0)).alias("linear"),
        F.when(enough & (c("mean") > 0), c("level") * c("f.season") / c("mean")).alias("index"),
        F.when(enough, c("f.naive")).alias("naive"))


def seasonal_forecast(t, months: int = 3, as_of: str | None = None) -> DataFrame:
    """PRD-5 with seasons: monthly revenue of the next ``months`` months per currency, product x frequency and in
    total, by the model that did best on the series' own past.

    Rolling-origin backtest: from each of the BACKTEST_MONTHS months before the last one, every model forecasts the
    months that follow up to the last; its error is the mean absolute difference. A model that lacks a figure in
    the backtest or for the future is out; without any backtest the linear model is taken. Output: model, the three
    errors (2 places) and forecast_revenue."""
    spine = scratch_table(_spine(t, as_of), "spine")
    last = (F.year(F.add_months(_d(as_of or t.as_of), -1)) * 12 + F.month(F.add_months(_d(as_of or t.as_of), -1))).cast("int")
    back = _models_at(spine, F.sequence(last - BACKTEST_MONTHS, last - 1), months)
    back = back.where(c("origin") + c("horizon") <= last)
    truth = spine.select(*[c(s).alias(f"t_{s}") for s in SERIES], c("x").alias("t_x"), c("y").alias("truth"))
    on = [c(s) == c(f"t_{s}") for s in SERIES] + [c("t_x") == c("origin") + c("horizon")]
    told = back.join(truth, on)
    errors = told.groupBy(*SERIES).agg(*[F.when(F.count(m) == F.count("*"), F.round(F.avg(F.abs(c(m) - c("truth"))), 2))
                                         .alias(f"{m}_error") for m in MODELS])
    future = _models_at(spine, F.array(last), months)
    usable = future.groupBy(*SERIES).agg(*[(F.count(m) == F.count("*")).alias(f"has_{m}") for m in MODELS])
    best = errors.join(usable, list(SERIES))
    ranked = F.array_min(F.array_compact(F.array(*[
        F.when(c(f"{m}_error").isNotNull() & c(f"has_{m}"), F.struct(c(f"{m}_error").alias("e"), F.lit(i).alias("i")))
        for i, m in enumerate(MODELS)])))
    best = best.select(*SERIES, *[f"{m}_error" for m in MODELS],
                       F.element_at(F.array(*[F.lit(m) for m in MODELS]), F.coalesce(ranked["i"], F.lit(0)) + 1).alias("model"))
    out = future.join(best, list(SERIES), "left").withColumn("model", F.coalesce("model", F.lit("linear")))
    figure = reduce(lambda a, m: F.when(c("model") == m, c(m)).otherwise(a), MODELS[1:], c("linear"))
    end = F.add_months(F.trunc(_d(as_of or t.as_of), "month"), -1)
    return out.select(*SERIES, F.add_months(end, c("horizon")).alias("month"), c("horizon").cast("int").alias("horizon"),
                      c("points").cast("bigint").alias("points"), "model", *[f"{m}_error" for m in MODELS],
                      F.round(F.greatest(figure, F.lit(0.0)), 2).alias("forecast_revenue"))


def quarter_forecast(t, as_of: str | None = None) -> DataFrame:
    """PRD-5 by quarter: the seasonal forecast of the next three months summed per series and calendar quarter, with
    the number of its months that lie in the forecast."""
    f = seasonal_forecast(t, 3, as_of)
    return f.groupBy(*SERIES, F.trunc("month", "quarter").alias("quarter")).agg(
        F.count("*").alias("months"), F.round(F.sum("forecast_revenue"), 2).alias("forecast_revenue"))


# ----------------------------------------------------------------------- PRD-7
SEGMENT_CUTS = (0.2, 0.4, 0.6, 0.8)


def rfm(t, as_of: str | None = None, paid: DataFrame | None = None) -> DataFrame:
    """Last payment, payments and monetary value per paying owner and currency (from ``derive.owner_payments`` of the
    same day where that is given)."""
    a = _d(as_of or t.as_of)
    if paid is not None:
        return paid.filter(c("payments") > 0).select("owner_id", "owner_type", "currency", "last_paid_at", "payments",
                                                     "monetary")
    r = D.revenue_facts(t).filter(c("paid_at") < a.cast("timestamp_ntz"))
    return r.groupBy("owner_id", "owner_type", "currency").agg(
        F.max("paid_at").alias("last_paid_at"), F.count("*").cast("bigint").alias("payments"),
        money(F.sum("amount")).alias("monetary"))


def rfm_segments(t, as_of: str | None = None, paid: DataFrame | None = None) -> DataFrame:
    """PRD-7: quintile scores from exact cut points (``functions.ordering.quantiles_together``: all columns in one
    sort) and a named segment, one row per owner. Money is scored within its currency; an owner that pays in several has
    the best of its money scores and lists its amounts per currency."""
    a = _d(as_of or t.as_of)
    # one row per owner with its amounts; read again for the cut points and for the scores
    base = scratch_table(
        rfm(t, as_of, paid).groupBy("owner_id", "owner_type").agg(
            F.datediff(a, F.max("last_paid_at")).cast("int").alias("recency_days"),
            F.sum("payments").cast("bigint").alias("frequency"),
            F.collect_list(F.struct("currency", "monetary")).alias("amounts")), "rfm")  # one entry per currency
    each = base.select("*", F.posexplode("amounts").alias("nth", "paid"))
    once = lambda x: F.when(c("nth") == 0, c(x))  # an owner counts once, its amounts each
    cuts = quantiles_together(
        each.select(once("recency_days").alias("recency_days"), once("frequency").alias("frequency"),
                    c("paid.monetary").alias("monetary"), c("paid.currency").alias("currency")),
        SEGMENT_CUTS, {"recency_days": (), "frequency": (), "monetary": ("currency",)})  # a row per column and currency
    cuts = scratch_table(cuts, "cuts")

    def above(x, points):
        return reduce(lambda p, q: p + q, [F.when(x > points[i], 1).otherwise(0) for i in range(len(SEGMENT_CUTS))])

    of = lambda metric: cuts.where(c("metric") == metric).select("cuts").scalar()
    money_cuts = F.broadcast(cuts.where(c("metric") == "monetary").select(c("part").alias("currency"), "cuts"))
    per_money = each.select("owner_id", "paid.*").join(money_cuts, "currency").groupBy("owner_id").agg(
        F.max(1 + above(c("monetary"), c("cuts"))).cast("int").alias("m_score"),
        money_list(c("currency"), c("monetary")).alias("monetary"))
    scored = base.select("owner_id", "owner_type", "recency_days", "frequency",
                         (5 - above(c("recency_days"), of("recency_days"))).cast("int").alias("r_score"),
                         (1 + above(c("frequency"), of("frequency"))).cast("int").alias("f_score"))
    scored = scored.join(per_money, "owner_id").select("owner_id", "owner_type", "recency_days", "frequency",
                                                       "monetary", "r_score", "f_score", "m_score")
    seg = (F.when((c("r_score") >= 4) & (c("f_score") >= 4), "champions")
           .when((c("r_score") <= 2) & (c("f_score") >= 3), "at_risk")
           .when((c("r_score") >= 4) & (c("f_score") <= 2), "new")
           .when((c("r_score") <= 2) & (c("f_score") <= 2), "hibernating").otherwise("regular"))
    return scored.withColumn("segment", seg)


def kmeans_segments(t, as_of: str | None = None, k: int = 4) -> DataFrame:
    """PRD-7: k-means (MLlib, fixed seed) on standardised log RFM."""
    from pyspark.ml import Pipeline
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import StandardScaler, VectorAssembler

    a = _d(as_of or t.as_of)
    each = scratch_table(rfm(t, as_of), "paid")  # read for the means and for the rows
    # money in units of its currency's mean, so that currencies can stand side by side
    mean = each.groupBy("currency").agg(F.avg(c("monetary").cast("double")).alias("mean"))
    base = scratch_table(each.join(F.broadcast(mean), "currency").groupBy("owner_id").agg(
        F.log1p(F.datediff(a, F.max("last_paid_at"))).alias("r"), F.log1p(F.sum("payments")).alias("f"),
        F.log1p(F.sum(c("monetary").cast("double") / c("mean"))).alias("m")), "rfm")  # read by every fitted stage
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["r", "f", "m"], outputCol="raw"),
                            StandardScaler(inputCol="raw", outputCol="features", withMean=True),
                            KMeans(k=k, seed=42, featuresCol="features", predictionCol="cluster")])
    return pipe.fit(base).transform(base).select("owner_id", c("cluster").cast("int").alias("cluster"))


# ----------------------------------------------------------------------- PRD-8 / PRD-9
def _last_months(t, as_of, months):
    end = F.trunc(_d(as_of or t.as_of), "month")
    return F.add_months(end, -months), end


def expected_ltv(t, as_of: str | None = None, months: int = 12) -> DataFrame:
    """PRD-8: ARPPU / monthly churn rate per owner type and currency over the last ``months`` complete
    months (12 unless told otherwise)."""
    lo, hi = _last_months(t, as_of, months)
    r = D.revenue_facts(t).filter((c("month") >= lo) & (c("month") < hi))
    arppu = (r.groupBy("owner_type", "currency", "month")
             .agg(F.sum("amount").alias("rev"), F.countDistinct("owner_id").alias("n"))
             .groupBy("owner_type", "currency").agg(ratio(F.sum("rev"), F.sum("n"), 4).alias("arppu")))
    am = D.active_owner_months(t, as_of).withColumn("month", F.add_months("month", 1))
    base = am.filter((c("month") >= lo) & (c("month") < hi)).groupBy("owner_type").agg(
        F.count("*").alias("owner_months"))
    ch = (D.churn_events(t, as_of).filter((c("churn_month") >= lo) & (c("churn_month") < hi))
          .select("owner_type", "owner_id", "churn_month").distinct()
          .groupBy("owner_type").agg(F.count("*").alias("churns")))
    churn = base.join(ch, "owner_type", "left").select(
        "owner_type", ratio(F.coalesce(c("churns"), F.lit(0)), c("owner_months")).alias("monthly_churn_rate"))
    return (arppu.join(churn, "owner_type", "full")
            .withColumn("expected_ltv", ratio(c("arppu"), c("monthly_churn_rate"), 2)))


SCENARIO_POINTS = (1, 2, 5)


def retention_scenarios(t, as_of: str | None = None, points=SCENARIO_POINTS, months: int = 12) -> DataFrame:
    """PRD-9: per currency, twelve-month revenue gained if the monthly churn rate (of the last ``months``
    complete months) fell by ``points`` points, on the latest month's MRR."""
    from .kpi import monthly_recurring_revenue
    lo, hi = _last_months(t, as_of, months)
    mrr = monthly_recurring_revenue(t, as_of).groupBy("currency").agg(F.max_by("mrr", "month").alias("mrr"))
    am = D.active_owner_months(t, as_of).withColumn("month", F.add_months("month", 1))
    owner_months = am.filter((c("month") >= lo) & (c("month") < hi)).agg(F.count("*")).scalar()
    churns = (D.churn_events(t, as_of).filter((c("churn_month") >= lo) & (c("churn_month") < hi))
              .select("owner_id", "churn_month").distinct().agg(F.count("*")).scalar())
    sc = F.explode(F.array(*[F.lit(p) for p in points])).alias("points")
    m = F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m")
    j = mrr.select("currency", "mrr", ratio(churns, owner_months).alias("churn_rate"), sc).withColumn(
        "new_churn_rate", F.round(F.greatest(c("churn_rate") - c("points") / 100.0, F.lit(0.0)), 6))
    gain = (j.select("*", m).groupBy("currency", "points", "churn_rate", "new_churn_rate", "mrr")
            .agg(F.sum(c("mrr") * (F.pow(1 - c("new_churn_rate"), c("m")) - F.pow(1 - c("churn_rate"), c("m"))))
                 .alias("gain")))
    return gain.select("currency", c("points").cast("int").alias("points"), "churn_rate", "new_churn_rate", "mrr",
                       dbl(c("gain"), 2).alias("revenue_gain_12m"))


# ----------------------------------------------------------------------- PRD-10..13
def retention_offers(t, as_of: str | None = None, k: int | None = None) -> DataFrame:
    """PRD-10: every owner at medium / high risk with its historical value; with ``k`` only the k most at risk."""
    risk = churn_risk_score(t, as_of).filter(c("risk_band") != "low")
    offers = risk.join(D.owner_value(t), "owner_id")
    return offers if k is None else offers.orderBy(F.desc("risk_score"), "owner_id").limit(k)


def next_best_plan(t, as_of: str | None = None, days: int = 90) -> DataFrame:
    """PRD-11: per current plan and currency, the move with the best retention-weighted MRR gain (with its
    number of moves). Moves between currencies have no gain in money and are not ranked."""
    from .migration import _active_on, plan_moves
    a = _d(as_of or t.as_of)
    mv = (plan_moves(t).filter((c("product_move") != "same") | (c("cycle_move") != "same"))
          .filter(c("from_currency") == c("to_currency")).withColumnRenamed("from_currency", "currency")
          .withColumn("day", F.date_add("move_date", days)).filter(c("day") < a))
    act = _active_on(t, mv.select("owner_id", c("from_subscription_id").alias("probe_id"), "day"))
    g = (mv.join(act, mv.from_subscription_id == act.probe_id)
         .groupBy("currency", "from_product", "from_frequency", "to_product", "to_frequency")
         .agg(F.count("*").alias("moves"), ratio(F.count_if("continued"), F.count("*")).alias("retention"),
              dbl(F.avg(c("to_mrr") - c("from_mrr")), 2).alias("avg_mrr_change"))
         .withColumn("score", dbl(c("retention") * c("avg_mrr_change"), 4)))
    w = Window.partitionBy("currency", "from_product", "from_frequency").orderBy(F.desc("score"), "to_product", "to_frequency")
    return g.withColumn("rk", F.row_number().over(w)).filter(c("rk") == 1).drop("rk")


def channel_investment(t, as_of: str | None = None) -> DataFrame:
    """PRD-12: channels ranked by LTV:CAC, then retention, within each currency."""
    from .diagnostics import channel_comparison
    cc = channel_comparison(t, as_of).select("channel", "currency", "acquired", "retained_share", "cac", "avg_ltv")
    cc = cc.withColumn("ltv_to_cac", ratio(c("avg_ltv"), c("cac"), 4))
    w = Window.partitionBy("currency").orderBy(  # one row per channel
        F.desc_nulls_last("ltv_to_cac"), F.desc_nulls_last("retained_share"), "channel")
    return cc.withColumn("investment_rank", F.row_number().over(w).cast("int"))


def value_risk_segments(t, as_of: str | None = None) -> DataFrame:
    """PRD-13: RFM segment x churn-risk band: owners and mean value, one amount per currency."""
    seg = rfm_segments(t, as_of).select("owner_id", "segment")
    risk = churn_risk_score(t, as_of).select("owner_id", "risk_band")
    both = seg.join(risk, "owner_id")
    keys = ["segment", "risk_band"]
    owners = both.groupBy(*keys).agg(F.count("*").alias("owners"))
    total = (both.join(rfm(t, as_of).select("owner_id", "currency", "monetary"), "owner_id")
             .groupBy(*keys, "currency").agg(F.sum("monetary").alias("total")))
    mean = c("total").cast("double") / c("owners")
    return (total.join(owners, keys).groupBy(*keys, "owners")
            .agg(money_list(c("currency"), mean).alias("avg_value")))

"""Driver tables -> the twelve subscription tables.

The driver ships TPC-H-style tables plus an ``events`` stream. Each domain
table is a Spark job over them: one order is one subscription (every tenth
order belongs to an organisation), its line items are payment attempts, and
the January ``events`` become touchpoints, engagement days and support cases.
Order dates are shifted so subscriptions end around the fixed ``as_of``.

All expressions are integer arithmetic, ``case``, dates and exact decimals,
so the DuckDB oracle (``subledger.plans.oracle_fixtures``) builds the same rows.

Scale notes: an owner's order (previous / next subscription) is computed in two
levels (``functions.ordering``), so no window ever holds one owner's rows; the
other shuffles are the per-order line numbering (``paid``, bounded by an order's
lines, co-partitioned with the join to ``sub_end`` on the order key), the
seat-user join and the engagement aggregate. ``plans`` is an 18-row literal and
is always broadcast.
"""

from __future__ import annotations

import os
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import AS_OF
from . import reference_data
from ..functions.ordering import Ordered, ordered_neighbours
from .schemas import TABLES

# Fixed values of the driver-table mapping.
DAY_SHIFT = 8218          # 1995-01-01 .. 2001-08-01  ->  2017-07-02 .. 2024-01-31
SIGNUP_BASE = "2017-01-01"
ENGAGEMENT_BASE = "2024-01-01"
CHANNELS_BY_DIGIT = [
    "Organic Search", "Direct", "Email", "Organic Social", "Paid Social", "Paid Search", "Referral",
    "Affiliate / Partner", "Campus Activation", "Promotional Campaign",
]


def _pad(c: Column, n: int) -> Column:
    """The key with zeros before it, ``n`` digits at least; longer keys stay whole."""
    s = c.cast("string")
    return F.lpad(s, F.greatest(F.length(s), F.lit(n)), F.lit("0"))


def _case(key: Column, values: list[str]) -> Column:
    """``case key when 0 then v0 when 1 then v1 ... else v_last``."""
    out = F.lit(values[-1])
    for i in range(len(values) - 2, -1, -1):
        out = F.when(key == i, F.lit(values[i])).otherwise(out)
    return out


def _at(d: Column, hours: int) -> Column:
    """date -> timestamp_ntz at ``hours`` o'clock."""
    ts = d.cast("timestamp_ntz")
    return ts + F.expr(f"interval {hours} hours") if hours else ts


def _days(d: Column, n: Column) -> Column:
    return F.date_add(d, n.cast("int"))


def sub_id(orderkey: Column) -> Column:
    return F.concat(F.lit("SUB"), _pad(orderkey + 1, 8))


def cust_id(key: Column) -> Column:
    return F.concat(F.lit("CUST"), _pad(key + 1, 6))


class Tables:
    """The twelve tables for one driver folder, built lazily as DataFrames.

    ``Tables.materialized(...)`` returns the same tables read back from
    Parquet written once to the shared checkpoint folder (what a deployment
    stores), so a run of many queries does not rebuild them.
    """

    names = list(TABLES)

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str = AS_OF):
        self.spark = spark
        self.sf_dir = sf_dir
        self.as_of = as_of
        self._overrides: dict[str, DataFrame] = {}

    # -- raw driver tables ---------------------------------------------------
    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.sf_dir, f"{name}.parquet"))

    @property
    def as_of_col(self) -> Column:
        return F.lit(self.as_of).cast("date")

    def with_tables(self, **tables: DataFrame) -> "Tables":
        """A copy where the named tables are replaced (edge fixtures, materialized copies)."""
        out = Tables(self.spark, self.sf_dir, self.as_of)
        out._overrides = {**self._overrides, **tables}
        out.__dict__.update(out._overrides)  # instance values win over cached_property
        return out

    def before(self, as_of: str) -> "Tables":
        """The tables as they stood before ``as_of``: rows dated from that day on are left out, and what
        happened later to older rows (a subscription's end, a trial's outcome, a case's resolution) is
        unknown again. Every operator on this view is an as-of figure; its own ``as_of`` is that day."""
        day = F.lit(as_of).cast("date")
        at = day.cast("timestamp_ntz")
        f = F.col
        later = F.coalesce(f("subscription_end_date") >= day, F.lit(False))

        def subscriptions():
            subs = self.subscriptions.filter(f("subscription_start_date") < day)
            return subs.select(*[
                F.when(~later, f(c)).alias(c) if c in ("subscription_end_date", "end_reason")
                else F.when(later, "active").otherwise(f(c)).alias(c) if c == "status"
                else F.when(f(c) < at, f(c)).alias(c) if c == "cancellation_requested_at" else f(c)
                for c in subs.columns])

        open_ = F.coalesce(f("actual_end_at") >= at, F.lit(False))

        def trials():
            rows = self.trials.filter(f("trial_started_at") < at)
            return rows.select(*[
                F.when(~open_, f(c)).alias(c) if c in ("actual_end_at", "converted_subscription_id")
                else F.when(open_, "active").otherwise(f(c)).alias(c) if c == "trial_status" else f(c)
                for c in rows.columns])

        unresolved = F.coalesce(f("resolved_at") >= at, F.lit(False))

        def support():
            rows = self.support_interactions.filter(f("interaction_at") < at)
            return rows.select(*[
                F.when(~unresolved, f(c)).alias(c) if c == "resolved_at"
                else F.when(unresolved, "open").otherwise(f(c)).alias(c) if c == "resolution_status" else f(c)
                for c in rows.columns])

        cut = {
            "customers": lambda: self.customers.filter(f("signup_date") < day), "subscriptions": subscriptions,
            "trials": trials, "payments": lambda: self.payments.filter(f("payment_attempted_at") < at),
            "subscription_events": lambda: self.subscription_events.filter(f("event_at") < at),
            "marketing_touchpoints": lambda: self.marketing_touchpoints.filter(f("touchpoint_at") < at),
            "customer_engagement": lambda: self.customer_engagement.filter(f("engagement_date") < day),
            "support_interactions": support}
        return LazyTables(self.spark, self.sf_dir, as_of,
                          lambda name: cut[name]() if name in cut else getattr(self, name))

    def materialized(self, path: str, buckets: int | None = None) -> "Tables":
        """Write all twelve tables once under ``path`` and read them back.

        The shared helpers (``sub_end``: one row per subscription with its owner neighbours,
        ``paid``: numbered payment attempts) feed several tables, so they are written once under
        ``path`` too and deleted when the twelve tables stand.
        With ``buckets`` the subscription-keyed tables are written as catalog tables bucketed by
        ``subscription_id`` (``sources.io.write_bucketed_tables``), so their joins skip the shuffle."""
        from ..session import remove_path
        from . import io

        def kept(name, df):
            df.write.parquet(os.path.join(path, name))
            return self.spark.read.schema(df.schema).parquet(os.path.join(path, name))

        helpers = self.with_tables()  # keeps any replaced tables
        helpers.__dict__["sub_end"] = kept("_helper_sub_end", self.sub_end)
        helpers.__dict__["paid"] = kept("_helper_paid", helpers.paid)
        if buckets:
            prefix = "t_" + os.path.basename(os.path.normpath(path)).replace("-", "_")
            names = io.write_bucketed_tables(helpers, path, buckets, prefix=prefix)
            for name in ("_helper_sub_end", "_helper_paid"):
                remove_path(self.spark, os.path.join(path, name))
            return io.load_bucketed_tables(self.spark, names, self)
        from concurrent.futures import ThreadPoolExecutor

        def write(name):
            target = os.path.join(path, name)
            getattr(helpers, name).write.mode("overwrite").parquet(target)
            return name, self.spark.read.schema(TABLES[name].schema).parquet(target)

        # the twelve writes are independent jobs; submitting them together lets the scheduler
        # overlap the small ones instead of running twelve mostly idle stages in a row
        with ThreadPoolExecutor(max_workers=4) as pool:
            written = dict(pool.map(write, self.names))
        for name in ("_helper_sub_end", "_helper_paid"):
            remove_path(self.spark, os.path.join(path, name))
        return self.with_tables(**written)

    # -- reference data ------------------------------------------------------
    @cached_property
    def products(self) -> DataFrame:
        return reference_data.products(self.spark)

    @cached_property
    def plans(self) -> DataFrame:
        return reference_data.plans(self.spark)

    # -- dimensions ----------------------------------------------------------
    @cached_property
    def customers(self) -> DataFrame:
        c = self.raw("customer")
        n = self.raw("nation").select("n_nationkey", "n_name")
        k = F.col("c_custkey")
        return c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).select(
            cust_id(k).alias("customer_id"),
            F.concat(F.lit("First"), (k % 97).cast("string")).alias("first_name"),
            F.col("c_name").alias("last_name"),
            F.concat(F.lit("first"), (k % 97).cast("string"), F.lit("."),
                     F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("-"))),
                     F.lit("@customer.example")).alias("email"),
            _days(F.lit(SIGNUP_BASE).cast("date"), k % 181).alias("signup_date"),
            F.col("n_name").alias("country"),
            F.when(k % 100 < 95, "active").when(k % 100 < 98, "suspended").otherwise("closed").alias("account_status"),
        )

    @cached_property
    def organisations(self) -> DataFrame:
        s = self.raw("supplier")
        k = F.col("s_suppkey")
        signup = _days(F.lit(SIGNUP_BASE).cast("date"), k % 181)
        return s.select(
            F.concat(F.lit("ORG"), _pad(k + 1, 4)).alias("organisation_id"),
            F.col("s_name").alias("organisation_name"),
            _case(k % 6, ["Corporate", "University", "Government", "NGO", "Professional Association", "Other"])
            .alias("organisation_type"),
            _case(k % 6, ["Technology", "Education", "Public Sector", "Development", "Healthcare", "Other"])
            .alias("industry"),
            (1 + (k * 7919) % 9973).cast("int").alias("organisation_size"),
            signup.alias("signup_date"),
            F.concat(F.lit("Contact "), F.col("s_name")).alias("billing_contact_name"),
            F.concat(F.lit("billing@"), F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit("-"))),
                     F.lit(".example")).alias("billing_contact_email"),
            F.when(k % 50 < 48, "active").when(k % 50 == 48, "suspended").otherwise("closed").alias("account_status"),
            _at(signup, 9).alias("created_at"),
        )

    # -- subscription helpers ------------------------------------------------
    @cached_property
    def sub_base(self) -> DataFrame:
        o = self.raw("orders")
        ok, ck = F.col("o_orderkey"), F.col("o_custkey")
        is_org = ok % 10 == 7
        return o.select(
            ok, ck, is_org.alias("is_org"),
            F.when(is_org, F.concat(F.lit("ORG"), _pad(F.floor(ck / 15) + 1, 4)))
            .otherwise(cust_id(ck)).alias("owner_id"),
            F.when(is_org, F.concat(F.lit("PLN"), _pad(17 + ck % 2, 3)))
            .otherwise(F.concat(F.lit("PLN"), _pad(1 + (ok * 7 + ck) % 16, 3))).alias("plan_id"),
            F.date_add(F.to_date("o_orderdate"), DAY_SHIFT).alias("start_date"),
            F.col("o_orderstatus"),
        )

    @cached_property
    def sub_end(self) -> DataFrame:
        """One row per subscription with its owner neighbours, actual end and reason."""
        p = self.plans.select("plan_id", F.col("billing_period_days").alias("bpd"), "unit_price")
        b = self.sub_base.join(F.broadcast(p), "plan_id")
        as_of = self.as_of_col

        def planned(bpd, start, key):
            return _days(start, bpd * (1 + key % 6))

        def reason(changed, lapsed, key):
            return (F.when(changed, "plan_change")
                    .when(lapsed, _case(key % 3, ["voluntary_cancel", "payment_failure", "non_renewal"])))

        f = F.col
        unique = not self.raw("orders").groupBy("o_orderkey").count().where("count > 1 or o_orderkey is null").head(1)
        if unique:  # a row's neighbours carry all it needs of them
            rows = Ordered(b, "owner_id", ("start_date", "o_orderkey"), tuple(b.columns)).neighbours(
                "start_date", "o_orderkey", "bpd")
            s = rows.select(
                "*", f("next.start_date").alias("next_start"), f("next.o_orderkey").alias("next_key"),
                f("prev.o_orderkey").alias("prev_key"),
                planned(f("prev.bpd"), f("prev.start_date"), f("prev.o_orderkey")).alias("prev_planned"))
            s = s.withColumn("prev_end_reason", reason(f("start_date") <= f("prev_planned"), f("prev_planned") <= as_of,
                                                       f("prev_key"))).drop("place", "prev", "next", "prev_planned")
        else:  # repeated keys: every row of a key meets every neighbour of the key
            nb = ordered_neighbours(b, "owner_id", "start_date", "o_orderkey").select(
                "o_orderkey", f("next_day").alias("next_start"), f("next_id").alias("next_key"),
                f("prev_id").alias("prev_key"))
            s = b.join(nb, "o_orderkey")
        s = s.withColumn("planned_end", planned(f("bpd"), f("start_date"), f("o_orderkey")))
        changed = f("next_start").isNotNull() & (f("next_start") <= f("planned_end"))
        lapsed = f("planned_end") <= as_of
        s = s.select("*", F.when(changed, f("next_start")).when(lapsed, f("planned_end")).alias("end_date"),
                     reason(changed, lapsed, f("o_orderkey")).alias("end_reason"))
        if not unique:
            prev = s.select(f("o_orderkey").alias("prev_key"), f("end_reason").alias("prev_end_reason"))
            s = s.join(prev, "prev_key", "left")
        return s.select(
            "*",
            F.floor(F.greatest(F.datediff(F.coalesce(f("end_date"), as_of), f("start_date")) - 1, F.lit(0))
                    / f("bpd")).cast("int").alias("k"),
        )

    @cached_property
    def subscriptions(self) -> DataFrame:
        s = self.sub_end
        ok = F.col("o_orderkey")
        open_cancel = F.col("end_date").isNull() & (ok % 7 == 0)
        return s.select(
            sub_id(ok).alias("subscription_id"),
            F.when(~F.col("is_org"), F.col("owner_id")).alias("customer_id"),
            F.when(F.col("is_org"), F.col("owner_id")).alias("organisation_id"),
            "plan_id",
            F.col("start_date").alias("subscription_start_date"),
            _days(F.col("start_date"), F.col("k") * F.col("bpd")).alias("current_period_start"),
            _days(F.col("start_date"), (F.col("k") + 1) * F.col("bpd")).alias("current_period_end"),
            F.col("end_date").alias("subscription_end_date"),
            F.when(F.col("end_date").isNotNull(), "ended").when(F.col("o_orderstatus") == "P", "past_due")
            .otherwise("active").alias("status"),
            (~open_cancel).alias("auto_renew"),
            F.when(open_cancel, _at(F.col("start_date"), 12)).alias("cancellation_requested_at"),
            "end_reason",
            F.when(F.col("is_org"), 10 + ok % 91).cast("int").alias("seats_purchased"),
            _at(F.col("start_date"), 8).alias("created_at"),
        )

    # -- payments --------------------------------------------------------------
    @cached_property
    def paid(self) -> DataFrame:
        """Line items numbered within their order and kept while the subscription ran."""
        li = self.raw("lineitem")
        w = Window.partitionBy("l_orderkey").orderBy(
            "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus")
        seq = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus",
                        F.row_number().over(w).alias("rn"))
        s = self.sub_end.select("o_orderkey", "is_org", "start_date", "end_date", "bpd", "unit_price")
        j = seq.join(s, seq.l_orderkey == s.o_orderkey)
        due = _days(F.col("start_date"), (F.col("rn") - 1) * F.col("bpd"))
        return j.filter((F.col("rn") == 1) | (due < F.coalesce(F.col("end_date"), self.as_of_col))).select(
            "*", _at(due, 10).alias("pay_time"),
            F.concat(F.lit("PAY"), _pad(F.col("l_orderkey") + 1, 8), F.lit("-"), F.col("rn").cast("string"))
            .alias("payment_id"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        p = self.paid
        ok = F.col("l_orderkey")
        failed = F.col("l_returnflag") == "R"
        return p.select(
            "payment_id",
            sub_id(ok).alias("subscription_id"),
            F.col("pay_time").alias("payment_attempted_at"),
            (F.col("unit_price") * F.when(F.col("is_org"), 10 + F.col("o_orderkey") % 91).otherwise(1))
            .cast("decimal(12,2)").alias("amount"),
            F.lit("KES").alias("currency"),
            F.when(failed, "failed").when(F.col("l_linenumber") == 7, "pending").otherwise("successful")
            .alias("payment_status"),
            _case(F.col("l_partkey") % 3, ["mobile_money", "card", "bank_transfer"]).alias("payment_method"),
            F.when(F.col("l_linestatus") == "F",
                   F.concat(F.lit("TX"), ok.cast("string"), F.lit("-"), F.col("rn").cast("string")))
            .alias("transaction_reference"),
            F.when(failed, _case(F.col("l_suppkey") % 6, ["insufficient_funds", "expired_card", "payment_declined",
                                                         "invalid_payment_details", "timeout", "other"]))
            .alias("failure_reason"),
            F.col("pay_time").alias("created_at"),
        )

    # -- lifecycle events --------------------------------------------------------
    @cached_property
    def subscription_events(self) -> DataFrame:
        cols = TABLES["subscription_events"].column_names
        s = self.sub_end
        ok = F.col("o_orderkey")

        def ev(df, tag, etype, at, with_rn=False, **extra):
            eid = F.concat(F.lit("EV" + tag), _pad(ok + 1, 8))
            if with_rn:
                eid = F.concat(eid, F.lit("-"), F.col("rn").cast("string"))
            out = {"event_id": eid, "subscription_id": sub_id(ok), "event_type": F.lit(etype), "event_at": at,
                   "created_at": at, **extra}
            typed = TABLES["subscription_events"].schema
            return df.select(*[(out[c] if c in out else F.lit(None)).cast(typed[c].dataType).alias(c) for c in cols])

        first_or_change = F.col("prev_key").isNull() | (F.col("prev_end_reason") == "plan_change")
        cancel_req = ((F.col("end_reason") == "voluntary_cancel")
                      | (F.col("end_date").isNull() & (ok % 7 == 0))
                      | ((F.col("end_reason") == "non_renewal") & (ok % 4 == 1)))
        p = self.paid
        branches = [
            ev(s.filter(first_or_change), "S", "subscription_started", _at(F.col("start_date"), 8)),
            ev(s.filter(~first_or_change), "A", "reactivated", _at(F.col("start_date"), 8),
               related_subscription_id=sub_id(F.col("prev_key"))),
            ev(s.filter(F.col("end_reason") == "plan_change"), "C", "plan_changed", _at(F.col("end_date"), 8),
               related_subscription_id=sub_id(F.col("next_key"))),
            ev(s.filter(F.col("end_date").isNotNull()), "E", "subscription_ended", _at(F.col("end_date"), 8),
               event_reason=F.col("end_reason")),
            ev(s.filter(cancel_req), "Q", "cancellation_requested", _at(F.col("start_date"), 12)),
            ev(s.filter((F.col("end_reason") == "non_renewal") & (ok % 4 == 1)), "V", "cancellation_reversed",
               _at(F.col("start_date"), 13)),
            ev(p.filter((F.col("rn") > 1) & (F.col("l_returnflag") != "R") & (F.col("l_linenumber") != 7)),
               "R", "renewed", F.col("pay_time"), with_rn=True,
               triggering_payment_id=F.col("payment_id"),
               period_start=_days(F.col("start_date"), (F.col("rn") - 1) * F.col("bpd")),
               period_end=_days(F.col("start_date"), F.col("rn") * F.col("bpd"))),
            ev(p.filter(F.col("l_returnflag") == "R"), "P", "past_due_started", F.col("pay_time"), with_rn=True,
               triggering_payment_id=F.col("payment_id")),
            ev(p.filter((F.col("rn") == 1) & (F.col("l_returnflag") == "R")
                        & (F.col("end_date") > F.date_add(F.col("start_date"), 2))),
               "D", "past_due_resolved", _at(F.col("start_date"), 36)),
            ev(s.filter(F.col("is_org") & (ok % 4 == 1)), "X", "seats_changed", _at(F.col("start_date"), 14),
               previous_seat_count=10 + (ok * 3) % 91, new_seat_count=10 + ok % 91),
        ]
        out = branches[0]
        for b in branches[1:]:
            out = out.unionByName(b)
        return out

    # -- seats ---------------------------------------------------------------------
    @cached_property
    def organisation_users(self) -> DataFrame:
        s = self.sub_end.filter("is_org").withColumn("grp", F.floor(F.col("o_custkey") / 15))
        c = self.raw("customer").select("c_custkey").withColumn("grp", F.floor(F.col("c_custkey") / 15))
        ck = F.col("c_custkey")
        j = s.join(c, "grp")
        inactive_user = ck % 5 == 0
        return j.select(
            F.concat(F.lit("OU"), _pad(F.col("o_orderkey"), 7), F.lit("-"), _pad(ck, 7)).alias("organisation_user_id"),
            F.col("owner_id").alias("organisation_id"),
            sub_id(F.col("o_orderkey")).alias("subscription_id"),
            F.concat(F.lit("user"), ck.cast("string"), F.lit("@org.example")).alias("email"),
            F.col("start_date").alias("activation_date"),
            F.when(F.col("end_date").isNotNull(), F.col("end_date")).when(inactive_user, self.as_of_col)
            .alias("deactivation_date"),
            F.when(F.col("end_date").isNotNull() | inactive_user, "inactive").otherwise("active").alias("user_status"),
            _at(F.col("start_date"), 9).alias("created_at"),
        )

    # -- marketing -------------------------------------------------------------------
    @cached_property
    def marketing_touchpoints(self) -> DataFrame:
        b = self.sub_base.filter(~F.col("is_org"))
        ok, ck = F.col("o_orderkey"), F.col("o_custkey")
        paid_channel = ((ck + ok) % 10).isin(0, 1, 3)
        from_orders = b.select(
            F.concat(F.lit("TPO"), _pad(ok + 1, 8)).alias("touchpoint_id"),
            F.col("owner_id").alias("customer_id"),
            _at(F.date_sub(F.col("start_date"), (1 + ok % 5).cast("int")), 11).alias("touchpoint_at"),
            _case((ck + ok) % 10, CHANNELS_BY_DIGIT).alias("channel"),
            F.when(ok % 3 != 0, F.concat(F.lit("CMP"), (ok % 12).cast("string"))).alias("campaign_name"),
            _case(ok % 7, ["impression", "click", "visit", "email_open", "email_click", "referral",
                           "campaign_response"]).alias("touchpoint_type"),
            F.when(ok % 4 == 0, F.lit(None)).when(paid_channel, F.lit(0)).otherwise(5 + ok % 200)
            .cast("decimal(12,2)").alias("attributed_cost"),
            _at(F.col("start_date"), 0).alias("created_at"),
        )
        e = self.raw("events").filter(F.col("event_type") == "click")
        ek = F.col("event_id")
        from_clicks = e.select(
            F.concat(F.lit("TPE"), _pad(ek + 1, 8)).alias("touchpoint_id"),
            cust_id(F.col("user_id")).alias("customer_id"),
            F.col("ts").alias("touchpoint_at"),
            _case(ek % 10, CHANNELS_BY_DIGIT).alias("channel"),
            F.when(ek % 3 != 0, F.concat(F.lit("CMP"), (ek % 12).cast("string"))).alias("campaign_name"),
            F.lit("click").alias("touchpoint_type"),
            F.col("value").cast("decimal(12,2)").alias("attributed_cost"),
            F.col("ts").alias("created_at"),
        )
        return from_orders.unionByName(from_clicks)

    @cached_property
    def trials(self) -> DataFrame:
        s = self.sub_end.filter(~F.col("is_org") & F.col("prev_key").isNull() & (F.col("o_custkey") % 10 >= 3))
        ck = F.col("o_custkey")
        d = ck % 10
        return s.select(
            F.concat(F.lit("TRL"), _pad(ck + 1, 8)).alias("trial_id"),
            F.col("owner_id").alias("customer_id"),
            _case(ck % 3, ["PROD001", "PROD002", "PROD005"]).alias("product_id"),
            _at(F.date_sub(F.col("start_date"), 7), 8).alias("trial_started_at"),
            _at(F.col("start_date"), 8).alias("scheduled_end_at"),
            F.when(d == 3, F.lit(None)).when(d == 9, _at(F.date_sub(F.col("start_date"), 4), 0))
            .otherwise(_at(F.col("start_date"), 8)).alias("actual_end_at"),
            F.when(d == 3, "active").when(d <= 7, "converted").when(d == 8, "expired").otherwise("cancelled")
            .alias("trial_status"),
            F.when(d.between(4, 7), sub_id(F.col("o_orderkey"))).alias("converted_subscription_id"),
            _at(F.date_sub(F.col("start_date"), 7), 8).alias("created_at"),
        )

    # -- engagement and support ----------------------------------------------------------
    @cached_property
    def customer_engagement(self) -> DataFrame:
        e = self.raw("events").filter(F.col("event_type") == "view")
        ek = F.col("event_id")
        day = F.to_date("ts")
        g = e.groupBy(F.col("user_id"), day.alias("engagement_date")).agg(
            F.count("*").cast("int").alias("sessions_count"),
            F.sum(1 + ek % 9).cast("int").alias("articles_viewed"),
            F.sum((ek % 9) % 4).cast("int").alias("premium_articles_viewed"),
            F.sum(ek % 3).cast("int").alias("epaper_opens"),
            F.sum(F.col("value").cast("decimal(10,2)")).cast("decimal(10,2)").alias("reading_minutes"),
            F.max("ts").alias("created_at"),
        )
        return g.select(
            F.concat(F.lit("ENG"), _pad(F.col("user_id"), 7), F.lit("-"),
                     F.datediff(F.col("engagement_date"), F.lit(ENGAGEMENT_BASE).cast("date")).cast("string"))
            .alias("engagement_id"),
            cust_id(F.col("user_id")).alias("customer_id"),
            "engagement_date", "sessions_count", "articles_viewed", "premium_articles_viewed", "epaper_opens",
            "reading_minutes", "created_at",
        )

    @cached_property
    def support_interactions(self) -> DataFrame:
        e = self.raw("events").filter(F.col("event_type") == "error")
        ek = F.col("event_id")
        return e.select(
            F.concat(F.lit("SUP"), _pad(ek + 1, 8)).alias("interaction_id"),
            cust_id(F.col("user_id")).alias("customer_id"),
            F.lit(None).cast("string").alias("subscription_id"),
            F.col("ts").alias("interaction_at"),
            _case(ek % 4, ["email", "phone", "live_chat", "web_form"]).alias("channel"),
            _case(ek % 8, ["billing", "payment", "access_login", "technical", "content", "subscription_change",
                           "cancellation_enquiry", "other"]).alias("issue_category"),
            F.when(ek % 5 == 0, "open").when(ek % 5 == 1, "in_progress").otherwise("resolved").alias("resolution_status"),
            F.when(ek % 5 > 1, F.col("ts") + F.expr("interval 5 hours")).alias("resolved_at"),
            F.col("ts").alias("created_at"),
        )


class LazyTables(Tables):
    """A view whose tables are made by ``make(name)`` when they are first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str, make):
        super().__init__(spark, sf_dir, as_of)
        self._make = make

    def with_tables(self, **tables: DataFrame) -> "Tables":
        out = LazyTables(self.spark, self.sf_dir, self.as_of, lambda name: getattr(self, name))
        out._overrides = {**self._overrides, **tables}
        out.__dict__.update(out._overrides)
        return out


def _made(name: str) -> cached_property:
    prop = cached_property(lambda self: self._make(name))
    prop.__set_name__(LazyTables, name)
    return prop


for _name in TABLES:
    setattr(LazyTables, _name, _made(_name))


class _Stored(Tables):
    """Derives tables and helpers and writes each under ``path`` when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, as_of: str, path: str):
        super().__init__(spark, sf_dir, as_of)
        self.path = path
        self.written: list[str] = []

    def keep(self, name: str, df: DataFrame) -> DataFrame:
        target = os.path.join(self.path, name)
        df.write.mode("overwrite").parquet(target)
        self.written.append(target)
        return self.spark.read.schema(TABLES[name].schema if name in TABLES else df.schema).parquet(target)

    @cached_property
    def sub_end(self) -> DataFrame:
        return self.keep("_helper_sub_end", super().sub_end)

    @cached_property
    def paid(self) -> DataFrame:
        return self.keep("_helper_paid", super().paid)

    def table(self, name: str) -> DataFrame:
        return self.keep(name, getattr(self, name))


_CACHE: dict[tuple, tuple[Tables, _Stored]] = {}


def tables(spark: SparkSession, sf_dir: str, as_of: str = AS_OF) -> Tables:
    """The tables for ``sf_dir``: each is derived and written once per session under the shared checkpoint
    folder, when a query first reads it, then read from there by every query (again if that folder was emptied
    meanwhile). The copy is deleted when the process ends."""
    from ..session import path_exists, scratch_path

    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), as_of)
    t, store = _CACHE.get(key, (None, None))
    if t is None or t.spark is not spark or not all(path_exists(spark, p) for p in store.written):
        store = _Stored(spark, sf_dir, as_of, scratch_path(spark, "tables"))
        t = LazyTables(spark, sf_dir, as_of, store.table)
        _CACHE[key] = (t, store)
    return t

"""One query per operator. Results are settled for comparison: doubles keep single precision, other types are native."""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from checks.layers import CHECKED_FEATURES, REASON_RULES, ads, dwd, new_warehouse, newest, ods
from checks.observations import TIE_BREAKERS, rank_observations, table, user_heat
from rankhouse.fixed_values import FEMALE_CHANNEL, MALE_CHANNEL, SERIALISING
from rankhouse.functions.expressions import change, flag, percent_change
from rankhouse.functions.parsing import metric_number, month_start, plain_number, words_number
from rankhouse.operators import buckets, cleaning, stats, windows
from rankhouse.plans import extras, features, reports, responses
from rankhouse.plans.history import BookHistory
from rankhouse.plans.layers import run_layers
from rankhouse.plans.upserts import UpsertStore
from rankhouse.schema import METRICS, as_observations
from rankhouse.sources import items, tables
from rankhouse.sources.staging import fresh_path, materialize

Query = Callable[[SparkSession, str], DataFrame]


def settle(df: DataFrame) -> DataFrame:
    """Doubles as they are to 24 binary digits, about seven decimal ones: relative to size, what the order of a sum can change is far
    below that. Adding zero makes a negative zero a zero. All other types stay."""

    def settled(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DoubleType):
            column = column.cast("float").cast("double") + F.lit(0.0)
        return column.alias(field.name)

    return df.select(*map(settled, df.schema.fields))


QUERIES: dict[str, Query] = {}


def query(name: str):
    """Register a query; its result is settled."""

    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: settle(function(spark, sf_dir))
        return function

    return register


# --- sources and sinks ------------------------------------------------------------------------------------------
@query("src_layer_table")
def _(spark, sf_dir):
    return dwd(spark, sf_dir).select("book_id", "rank_date", "rank_name", *METRICS)


@query("sink_layer_write")
def _(spark, sf_dir):
    path = fresh_path(spark, "sink_layer_write")
    name = f"sink_layer_write_{path.split('/')[-2]}"
    rows = ods(spark, sf_dir).select("book_id", "title", "rank_date", "popularity")
    written = tables.write_layer(rows, name, path=path)
    return tables.read_layer(spark, name).withColumn("rows_written", F.lit(written).cast("bigint"))


@query("sink_layer_append")
def _(spark, sf_dir):
    """Two loads with an overlap of months; the second replaces the months it brings."""
    path = fresh_path(spark, "sink_layer_append")
    rows = ods(spark, sf_dir).select("book_id", "rank_name", "date_month", "number")
    tables.append_layer(rows.where("date_month < '199507'"), path)
    tables.append_layer(rows.where("date_month >= '199501'"), path, replace_partitions=True)
    loaded = spark.read.schema(rows.schema).parquet(path)
    return loaded.groupBy("date_month").agg(F.count(F.lit(1)).alias("row_count"), F.sum(F.col("number").cast("int")).alias("number_sum"))


@query("sink_verify_export")
def _(spark, sf_dir):
    return tables.verify(ads(spark, sf_dir, "ads_user_avoid_pitfalls"))


@query("sink_json")
def _(spark, sf_dir):
    path = fresh_path(spark, "sink_json")
    rows = ods(spark, sf_dir).select("book_id", "title", "author", "words_num", "status", "number", "unit", "rank_name", "score")
    items.write_lines(rows, path)
    return items.read_lines(spark, path, rows.schema)


@query("layers_run")
def _(spark, sf_dir):
    path = fresh_path(spark, "layers_run")
    warehouse = new_warehouse(spark, sf_dir, f"layers_{path.split('/')[-2]}")
    return run_layers(warehouse, ["ods", "dwd", "ads"]).select("layer", "ok", "rows")


@query("layers_removed")
def _(spark, sf_dir):
    """Rows that each rule of the cleaning removed, as the run of the layers reports them."""
    path = fresh_path(spark, "layers_removed")
    warehouse = new_warehouse(spark, sf_dir, f"removed_{path.split('/')[-2]}")
    outcome = run_layers(warehouse, ["ods", "dwd"]).where("layer = 'dwd_rank_facts'")
    return outcome.select("layer", "rows", *(c for c in outcome.columns if c.startswith("removed_")))


@query("ads_from_totals")
def _(spark, sf_dir):
    """The three tables that one pass over the history serves, put together by book and status."""
    totals = materialize(features.book_totals(dwd(spark, sf_dir)), "book_totals")
    ltv, decay, power = (features.OVER_TOTALS[name](totals) for name in ("ads_capital_ltv", "ads_author_attenuation_effect", "ads_capital_future_purchasing_power"))
    ltv = ltv.select("book_id", "title", "category2_name", "status", "total_heat_integral", "appearance_count", "ltv_score", "ip_type")
    decay = decay.select("book_id", "title", "status", "total_attenuation", "avg_attenuation_speed", "lifecycle_days", "attenuation_type")
    power = power.select("book_id", "title", "avg_arpu", "max_arpu", "fan_value_score", "investment_value_level")
    return ltv.join(decay, ["book_id", "title", "status"]).join(power, ["book_id", "title"])


@query("layers_append")
def _(spark, sf_dir):
    """Two loads of the raw layer, the second repeats some months of the first; then the cleaned layer over all of them."""
    path = fresh_path(spark, "layers_append")
    warehouse = new_warehouse(spark, sf_dir, f"appended_{path.split('/')[-2]}", append=True)
    everything = warehouse.source
    warehouse.source = lambda: everything().where("date_month < '199507'")
    run_layers(warehouse, ["ods"])
    warehouse.source = lambda: everything().where("date_month >= '199501'")
    run_layers(warehouse, ["ods", "dwd"])
    return warehouse.layer("dwd_rank_facts").select("book_id", "rank_date", "rank_name", "status", *METRICS)


@query("src_sample")
def _(spark, sf_dir):
    """A tenth of the books, with all their rows; the same ones in any engine."""
    return tables.sample(dwd(spark, sf_dir), 0.1, keys=["book_id"]).select("book_id", "rank_date", "numeric_popularity")


# --- cleaning ---------------------------------------------------------------------------------------------------
@query("clean_drop_column")
def _(spark, sf_dir):
    rows = rank_observations(spark, sf_dir).select("book_id", "author", "rank_date", F.lit("text").alias("intro"))
    return cleaning.drop_column(rows)


@query("clean_newlines")
def _(spark, sf_dir):
    return cleaning.replace_newlines(rank_observations(spark, sf_dir)).select("book_id", "title", "rank_date")


@query("clean_drop_empty_columns")
def _(spark, sf_dir):
    return cleaning.drop_empty_columns(ods(spark, sf_dir).select("book_id", "image_link", "date_type", "date_month", "number"))


@query("clean_any_key_present")
def _(spark, sf_dir):
    rows = ods(spark, sf_dir).withColumn("author", F.expr("CASE WHEN book_id IS NULL AND number < '3' THEN NULL ELSE author END"))
    return cleaning.keep_any_key(rows.withColumn("title", F.expr("CASE WHEN author IS NULL THEN NULL ELSE title END"))).select(
        "book_id", "title", "author", "rank_date"
    )


@query("clean_bad_keys")
def _(spark, sf_dir):
    return cleaning.drop_bad_keys(ods(spark, sf_dir), removed=Observation()).select("book_id", "rank_date", "title")


@query("clean_status_decode")
def _(spark, sf_dir):
    return cleaning.decode_status(ods(spark, sf_dir)).select("book_id", "rank_date", "status")


@query("clean_invalid_titles")
def _(spark, sf_dir):
    return cleaning.drop_invalid_titles(ods(spark, sf_dir)).select("book_id", "rank_date", "title")


@query("clean_unit_parse")
def _(spark, sf_dir):
    return cleaning.parse_metrics(ods(spark, sf_dir)).select("popularity", "numeric_popularity", "read_count", "numeric_read_count").withColumnsRenamed(
        {"popularity": "popularity_text", "read_count": "read_count_text"}
    )


@query("clean_score_parse")
def _(spark, sf_dir):
    return cleaning.parse_score(ods(spark, sf_dir)).select("book_id", F.col("score").alias("score_text"), "numeric_score")


@query("clean_words_parse")
def _(spark, sf_dir):
    return cleaning.parse_words(ods(spark, sf_dir)).select("book_id", "words_num", "numeric_words")


def _numeric(spark, sf_dir):
    return cleaning.numeric_rows(ods(spark, sf_dir), tie_breakers=TIE_BREAKERS)


@query("clean_mean_fill")
def _(spark, sf_dir):
    rows = materialize(_numeric(spark, sf_dir).select("book_id", "rank_date", *METRICS))
    return cleaning.fill_numbers(rows)


@query("clean_iqr_cap")
def _(spark, sf_dir):
    rows = materialize(_numeric(spark, sf_dir).select("book_id", "rank_date", "numeric_popularity"))
    return cleaning.cap_outliers(cleaning.fill_numbers(rows, ["numeric_popularity"]))


@query("clean_fill_labels")
def _(spark, sf_dir):
    rows = cleaning.fill_labels(ods(spark, sf_dir))
    return rows.select("book_id", "rank_date", "category1_name", "category2_name", "status", "rank_name", "gender_type")


@query("clean_quality_score")
def _(spark, sf_dir):
    rows = cleaning.parse_score(cleaning.parse_metrics(ods(spark, sf_dir)))
    return cleaning.score_quality(rows).select("book_id", "rank_date", "data_quality_score")


@query("clean_all")
def _(spark, sf_dir):
    return cleaning.clean_all(ods(spark, sf_dir), tie_breakers=TIE_BREAKERS)


# --- aggregates -------------------------------------------------------------------------------------------------
@query("agg_global_means")
def _(spark, sf_dir):
    return stats.means(dwd(spark, sf_dir), METRICS)


@query("agg_global_quartiles")
def _(spark, sf_dir):
    found = stats.exact_quantiles(dwd(spark, sf_dir), METRICS[:3], [0.25, 0.5, 0.75])
    parts = [F.col("quantiles")[i].alias(name) for i, name in enumerate(("q1", "median", "q3"))]
    return found.select(F.col("metric").alias("metric_name"), *parts)


@query("agg_feature_groups")
def _(spark, sf_dir):
    """The feature groups over the whole history instead of the newest rows."""
    return features.reason_totals(dwd(spark, sf_dir), REASON_RULES)


@query("agg_attenuation")
def _(spark, sf_dir):
    return features.attenuation_totals(dwd(spark, sf_dir))


@query("agg_ltv")
def _(spark, sf_dir):
    return features.long_term_totals(dwd(spark, sf_dir))


@query("agg_purchasing")
def _(spark, sf_dir):
    return features.purchasing_totals(dwd(spark, sf_dir))


# --- windows ----------------------------------------------------------------------------------------------------
@query("win_dedup_latest")
def _(spark, sf_dir):
    rows = cleaning.keep_latest(cleaning.valid_rows(ods(spark, sf_dir)), tie_breakers=TIE_BREAKERS)
    return rows.select("book_id", "rank_date", "popularity", "score", "updated_at")


@query("win_latest_per_entity")
def _(spark, sf_dir):
    return windows.latest_per_book(dwd(spark, sf_dir)).select("book_id", "rank_date", "rank_name", "status", *METRICS)


@query("win_latest_per_entity_list")
def _(spark, sf_dir):
    newest = windows.latest(dwd(spark, sf_dir), ["book_id", "rank_name"], ["rank_date"])
    return newest.select("book_id", "rank_name", "rank_date", "numeric_popularity")


def _with_previous(spark, sf_dir, metric, name):
    rows = dwd(spark, sf_dir).select("book_id", "rank_date", metric)
    return rows.withColumn(name, windows.previous(metric, windows.history()))


@query("win_lag_popularity")
def _(spark, sf_dir):
    return _with_previous(spark, sf_dir, "numeric_popularity", "prev_day_popularity")


@query("win_lag_read_count")
def _(spark, sf_dir):
    return _with_previous(spark, sf_dir, "numeric_read_count", "prev_read_count")


@query("win_lag_of_lag")
def _(spark, sf_dir):
    rows = features.heat_momentum(dwd(spark, sf_dir))
    return rows.select("book_id", "rank_date", "popularity_diff", "prev_popularity_diff", "popularity_acceleration")


@query("win_category_avg")
def _(spark, sf_dir):
    rows = features.heat_momentum(dwd(spark, sf_dir)).select("book_id", "rank_date", "category1_name", "popularity_growth_rate")
    return stats.with_group_stats(rows, ["category1_name"], {"category_avg_growth_rate": F.avg("popularity_growth_rate")})


@query("win_history_appended")
def _(spark, sf_dir):
    """Lags and peaks of three loads, each from the state that the one before left."""
    path = fresh_path(spark, "win_history_appended")
    walked = BookHistory(spark, f"history_{path.split('/')[-2]}", path)
    rows = dwd(spark, sf_dir).select("book_id", "rank_date", "numeric_popularity")
    for dates in ("rank_date < '1996-03-15'", "rank_date >= '1996-03-15' AND rank_date < '1998-01-01'", "rank_date >= '1998-01-01'"):
        walked.append(rows.where(dates))
    names = {"value": "numeric_popularity", "previous": "prev_day_popularity", "diff": "popularity_diff", "growth_rate": "popularity_growth_rate"}
    names |= {"previous_diff": "prev_popularity_diff", "acceleration": "popularity_acceleration", "peak": "peak_popularity"}
    return walked.read().withColumnsRenamed(names)


@query("win_peak")
def _(spark, sf_dir):
    rows = dwd(spark, sf_dir).select("book_id", "rank_date", "numeric_popularity")
    return rows.withColumn("peak_popularity", F.max("numeric_popularity").over(windows.lifetime()))


@query("win_peak_date")
def _(spark, sf_dir):
    rows = dwd(spark, sf_dir).select("book_id", "rank_date", "numeric_popularity")
    return rows.withColumn("peak_date", windows.peak_date("numeric_popularity", windows.lifetime()))


def _current(spark, sf_dir):
    return windows.latest_per_book(dwd(spark, sf_dir)).select("book_id", "category1_name", "category2_name", "gender_type", "numeric_popularity")


@query("win_dense_rank")
def _(spark, sf_dir):
    return stats.with_dense_rank(_current(spark, sf_dir), ["category1_name", "gender_type"], "numeric_popularity", "category_heat_rank")


@query("win_dense_rank_sub")
def _(spark, sf_dir):
    groups = ["category1_name", "category2_name", "gender_type"]
    return stats.with_dense_rank(_current(spark, sf_dir), groups, "numeric_popularity", "subcategory_heat_rank")


@query("win_group_avg")
def _(spark, sf_dir):
    return stats.with_group_stats(_current(spark, sf_dir), ["category1_name", "gender_type"], {"group_avg": F.avg("numeric_popularity")})


# --- scalar functions -------------------------------------------------------------------------------------------
@query("scalar_functions")
def _(spark, sf_dir):
    rows = ods(spark, sf_dir)
    value = plain_number(F.col("score"))
    day = F.col("rank_date").try_cast("date")
    return rows.select(
        "book_id",
        F.contains("popularity", F.lit("万")).alias("has_unit"),
        F.regexp_replace("title", "[aeiou]", "_").alias("title_masked"),
        F.col("book_id").rlike("^https?://").alias("is_url"),
        F.length("title").alias("title_length"),
        F.col("title").like("%red%").alias("title_like"),
        F.datediff(day, "created_at").alias("age_days"),
        F.date_format(day, "yyyy-MM-dd").alias("day_text"),
        F.least(value / 10, F.lit(0.75)).alias("capped"),
        F.round(value / 3, 2).alias("rounded_two"),
        F.round(value / 7, 4).alias("rounded_four"),
        flag(value.between(6, 8)).alias("is_middle"),
        flag(F.col("status").isin("0", "1")).alias("is_code"),
        metric_number(F.col("read_count")).alias("read_value"),
        words_number(F.col("words_num")).alias("words_value"),
        change(value, F.lit(None).cast("double")).alias("no_change"),
        percent_change(value, F.lit(8.0)).alias("from_eight"),
        month_start(F.col("date_month")).alias("month_day"),
    )


# --- feature tables ---------------------------------------------------------------------------------------------
def _register_features():
    for name, feature in CHECKED_FEATURES.items():
        layer = newest if name in features.OVER_NEWEST else dwd
        query(name)(lambda spark, sf_dir, feature=feature, layer=layer: feature(layer(spark, sf_dir)))


_register_features()


@query("ads_all")
def _(spark, sf_dir):
    """Rows of every feature table, all registered features run over one cleaned layer."""
    counts = [
        ads(spark, sf_dir, name).agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("feature"), "row_count")
        for name in CHECKED_FEATURES
    ]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


@query("row_purchasing_labels")
def _(spark, sf_dir):
    rows = features.paying_rows(dwd(spark, sf_dir))
    return rows.select("book_id", "rank_date", "rank_number", "fan_quality_index", "is_high_arpu", "fan_stickiness_level", "purchasing_power_rating")


def _user_observations(spark, sf_dir):
    mapping = {
        "book_id": "cast(user_id as string)",
        "title": "concat('user ', user_id)",
        "author": "category",
        "category1_name": "category",
        "rank_date": "d",
        "created_at": "cast(d as timestamp)",
        "numeric_popularity": "round(metric, 2) * 100000",
        "numeric_read_count": "round(metric, 2) * 1000",
        "numeric_score": "7.5",
        "numeric_words": "600000",
    }
    defaults = {"category2_name": "all", "status": SERIALISING, "gender_type": "unknown", "rank_name": "daily", "number": "1"}
    return as_observations(user_heat(spark, sf_dir), mapping, defaults)


@query("events_heat")
def _(spark, sf_dir):
    return features.platform_heat(_user_observations(spark, sf_dir)).select(
        "book_id", "category1_name", "rank_date", "popularity_diff", "popularity_acceleration", "is_new_book", "heat_level"
    )


@query("events_ltv")
def _(spark, sf_dir):
    return features.capital_ltv(_user_observations(spark, sf_dir)).select(
        "book_id", "appearance_count", "lifecycle_days", "total_heat_integral", "heat_volatility", "ip_type", "adaptation_suggestion"
    )


# --- dashboard --------------------------------------------------------------------------------------------------
def _report(name, table_name, report, **options):
    query(name)(lambda spark, sf_dir: report(ads(spark, sf_dir, table_name), **options))


_report("q_heat_growth_top", "ads_platform_heat", reports.heat_growth_top)
_report("q_new_book_trend", "ads_platform_heat", reports.new_book_trend)
_report("q_category_avg_heat", "ads_author_reason", reports.category_avg_heat)
_report("q_wordcount_vs_heat", "ads_capital_ltv", reports.wordcount_vs_heat)
_report("q_status_heat_compare", "ads_capital_ltv", reports.status_heat_compare)
_report("q_top_books", "ads_user_layered_recommendation", reports.top_books)
_report("q_categories", "ads_user_layered_recommendation", reports.categories)
_report("q_high_heat_low_score", "ads_user_avoid_pitfalls", reports.high_heat_low_score)
_report("q_ip_value_top", "ads_capital_ltv", reports.ip_value_top)
_report("q_payment_power", "ads_capital_future_purchasing_power", reports.payment_power)

# --- documented reports and features ----------------------------------------------------------------------------
_report("doc_heat_surge_top", "ads_platform_heat", reports.heat_surge_top)
_report("doc_unworthy_report", "ads_platform_ranking_trend", reports.unworthy_report)
_report("doc_niche_hits", "ads_user_layered_recommendation", reports.niche_hits, gender="male", category="ECONOMY")
_report("doc_ip_investment", "ads_capital_ltv", reports.ip_investment)
_report("doc_high_arpu_fans", "ads_capital_future_purchasing_power", reports.high_arpu_fans)
_report("doc_ltv_log", "ads_capital_ltv", extras.ltv_log)
_report("doc_risk_rules", "ads_user_avoid_pitfalls", extras.risk_rules)
_report("rule_ip_levels", "ads_capital_ltv", lambda ltv: buckets.ip_levels(ltv).select("book_id", "status", "ltv_score", "ip_potential_level"))


def _over_dwd(name, operator):
    query(name)(lambda spark, sf_dir: operator(dwd(spark, sf_dir)))


_over_dwd("doc_dwd_profile", reports.dwd_profile)
_over_dwd("custom_feature_roi", extras.roi)
_over_dwd("doc_ranking_stability", extras.ranking_stability)
_over_dwd("doc_days_since_completion", extras.days_since_completion)
_over_dwd("doc_keyword_lift", partial(extras.keyword_lift, rules=REASON_RULES))
_over_dwd("doc_words_regression", partial(extras.words_regression, rules=REASON_RULES))
_over_dwd("doc_heat_trapezoid", extras.heat_trapezoid)
_over_dwd("rule_author_levels", buckets.author_levels)
_over_dwd("rule_heat_levels", lambda df: buckets.heat_levels(df).groupBy("heat_level").agg(F.count("*").alias("row_count")))
_over_dwd("rule_category_levels", lambda df: buckets.category_levels(windows.latest_per_book(df)))


@query("doc_category_avg_heat")
def _(spark, sf_dir):
    reason = ads(spark, sf_dir, "ads_author_reason").select(*features.REASON_GROUPS, "avg_popularity")
    return extras.reason_with_category_heat(dwd(spark, sf_dir), reason)


@query("rule_quality_weighted")
def _(spark, sf_dir):
    rows = cleaning.parse_score(cleaning.parse_metrics(ods(spark, sf_dir)))
    return cleaning.score_quality_weighted(rows).select("book_id", "rank_date", "data_quality_score")


def _filled(strategy):
    def run(spark, sf_dir):
        rows = materialize(_numeric(spark, sf_dir).select("book_id", "rank_date", *METRICS))
        return cleaning.fill_numbers(rows, strategy=strategy)

    return run


query("fill_strategy_median")(_filled("median"))
query("fill_strategy_mode")(_filled("mode"))


# --- stored responses -------------------------------------------------------------------------------------------
def rank_list_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stored response per order: none to three books, some with absent fields, some broken."""
    parts = F.transform(
        F.when(F.col("o_orderkey") % 4 == 0, F.array().cast("array<int>")).otherwise(
            F.sequence(F.lit(1), (F.col("o_orderkey") % 4).cast("int"))
        ),
        lambda i: F.struct(
            F.concat(F.lit("B"), (F.col("o_custkey") + i).cast("string")).alias("book_id"),
            F.concat(F.lit('title "'), F.col("o_orderpriority"), F.lit('"')).alias("title"),
            F.when(F.col("o_orderkey") % 5 != 0, F.concat(F.lit("author "), F.col("o_custkey").cast("string"))).alias("author"),
            F.col("o_orderstatus").alias("is_over"),
            i.cast("string").alias("number"),
            F.lit("万").alias("unit"),
        ),
    )
    good = F.to_json(F.struct(F.struct(parts.alias("table_data")).alias("data")))
    body = F.when(F.col("o_orderkey") % 13 == 0, F.lit("<html>busy</html>")).when(F.col("o_orderkey") % 17 == 0, F.lit('{"msg":"rate limited"}')).otherwise(good)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("date_month"), body.alias("body"))


@query("x_ranklist_flatten")
def _(spark, sf_dir):
    return responses.split_rank_lists(rank_list_responses(spark, sf_dir))[0]


@query("x_ranklist_rejects")
def _(spark, sf_dir):
    return responses.split_rank_lists(rank_list_responses(spark, sf_dir))[1]


PAGE_PATTERNS = {
    "page_lang": '<html lang="([a-z]+)"',
    "page_title": "<title>([^<]*)</title>",
    "first_link": '<a href="/([^"]*)"',
    **responses.DETAIL_PATTERNS,
}
#: Pages without an answer, and pages with some of the detail fields: padded, empty or absent.
PAGE_HTML = (
    "case when mod(page_id,11)=0 then null else concat(html, case when mod(page_id,3)=0 then '<em class=\"score\"> 8.5 </em>' "
    "when mod(page_id,3)=1 then '<em class=\"score\">  </em>' else '' end, case when mod(page_id,2)=0 then concat('<em class=\"read_count\">', "
    "cast(page_id as string), '万</em>') else '' end, case when mod(page_id,5)=0 then '<em class=\"popularity\">3亿</em><em class=\"popularity\">4</em>' "
    "else '' end) end"
)


@query("x_detail_extract")
def _(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").withColumn("html", F.expr(PAGE_HTML))
    return responses.extract_details(pages, PAGE_PATTERNS)


def _items(spark, sf_dir):
    """Crawled items: channel, list, month and outcome, in order of arrival. Books are listed in both channels."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    channel = F.when(F.col("l_partkey") % 19 == 0, F.lit("?")).when(F.col("l_linenumber") % 2 == 0, F.lit(MALE_CHANNEL)).otherwise(F.lit(FEMALE_CHANNEL))
    lists = F.element_at(F.array(*map(F.lit, ("大热", "新书", "完结", "收藏", "更新"))), (F.col("l_orderkey") % 5 + 1).cast("int"))
    month = F.when(F.col("l_orderkey") % 5 >= 3, F.lit("")).otherwise(F.date_format("o_orderdate", "yyyyMM"))
    return rows.select(
        F.concat(F.lit("B"), F.col("l_partkey").cast("string")).alias("book_id"),
        channel.alias("gender"),
        lists.alias("rank_name"),
        month.alias("date_month"),
        F.ceil(F.col("l_quantity") / 10).cast("int").alias("page"),
        F.col("l_quantity").cast("int").cast("string").alias("number"),
        (F.col("l_orderkey") % 23 == 0).alias("error"),
        F.col("l_shipdate").cast("timestamp").alias("arrival"),
        F.col("l_orderkey").alias("request"),
        F.col("l_extendedprice").cast("bigint").alias("response_size"),
    )


@query("x_upsert_latest")
def _(spark, sf_dir):
    """A stored table, then a later load of records for old and new keys."""
    known = responses.known_channels(_items(spark, sf_dir)).drop("error")
    path, ties = fresh_path(spark, "x_upsert_latest"), ["request", "number", "response_size", "page"]
    store = UpsertStore(spark, f"upsert_{path.split('/')[-2]}", path, known.schema, tie_breakers=ties)
    store.load(known.where("arrival < timestamp'1996-01-01'"))
    store.load(known.where("arrival >= timestamp'1996-01-01'"))
    return store.read().select("book_id", "rank_name", "date_month", "gender", "number", "arrival", "request")


@query("x_upsert_compacted")
def _(spark, sf_dir):
    """The same stored table compacted between two loads, a part of the records loaded twice."""
    known = responses.known_channels(_items(spark, sf_dir)).drop("error")
    path, ties = fresh_path(spark, "x_upsert_compacted"), ["request", "number", "response_size", "page"]
    store = UpsertStore(spark, f"upsert_{path.split('/')[-2]}", path, known.schema, tie_breakers=ties)
    store.load(known.where("arrival < timestamp'1996-01-01'"))
    store.load(known.where("arrival < timestamp'1995-06-01'"))
    store.compact()
    store.load(known.where("arrival >= timestamp'1996-01-01'"))
    return store.read().select("book_id", "rank_name", "date_month", "gender", "number", "arrival", "request")


@query("x_gender_unify")
def _(spark, sf_dir):
    rows = _items(spark, sf_dir).select("book_id", "gender", "rank_name", "date_month", "number")
    male, female = (rows.where(F.col("gender") == channel).drop("gender") for channel in (MALE_CHANNEL, FEMALE_CHANNEL))
    return responses.unify_genders(male, female)


@query("x_coverage_gaps")
def _(spark, sf_dir):
    grid = responses.expected_requests(spark, first_month="199401")
    return responses.coverage_gaps(grid, _items(spark, sf_dir))


@query("x_crawl_stats")
def _(spark, sf_dir):
    return responses.crawl_stats(_items(spark, sf_dir))

"""The same results as plain SQL over the test tables, written independently of the Spark jobs. Labels, thresholds and patterns in
the statements are fixed values of the contract."""

from __future__ import annotations

from checks.layers import HOT_KEYWORDS
from checks.observations import TIE_BREAKERS, duckdb_sql
from checks.queries import PAGE_HTML

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def number(text: str) -> str:
    return f"CASE WHEN regexp_matches(trim({text}), '{NUMBER}') THEN TRY_CAST(trim({text}) AS DOUBLE) END"


def metric(column: str) -> str:
    return (
        f"CASE WHEN contains({column}, '亿') THEN ({number(f"replace({column}, '亿', '')")}) * 100000000 "
        f"WHEN contains({column}, '万') THEN ({number(f"replace({column}, '万', '')")}) * 10000 ELSE {number(column)} END"
    )


def words(column: str) -> str:
    return (
        f"CASE WHEN contains({column}, '万字') THEN ({number(f"replace({column}, '万字', '')")}) * 10000 "
        f"WHEN contains({column}, '字') THEN ({number(f"replace({column}, '字', '')")}) ELSE {number(column)} END"
    )


STATUS = "CASE status WHEN '0' THEN '连载中' WHEN '1' THEN '已完结' ELSE status END"
GOOD_KEYS = (
    "NOT regexp_matches(book_id, '^https?://') AND regexp_matches(rank_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') "
    "AND TRY_CAST(rank_date AS DATE) IS NOT NULL"
)
METRICS = ("numeric_popularity", "numeric_read_count", "numeric_score", "numeric_words")
TIES = ", ".join(f"{c} ASC NULLS LAST" for c in TIE_BREAKERS)

# Common table expressions, in order; a query names the last one it needs.
CTES = {
    "obs": duckdb_sql(),
    "ods": "SELECT * REPLACE (regexp_replace(title, '[\n\r]', ' ', 'g') AS title) FROM obs",
    "valid": f"SELECT * REPLACE ({STATUS} AS status) FROM ods "
    f"WHERE coalesce(book_id, title, author) IS NOT NULL AND {GOOD_KEYS} AND title NOT IN ('0', '1')",
    "uniq": "SELECT * FROM valid QUALIFY row_number() OVER (PARTITION BY book_id, rank_date "
    f"ORDER BY updated_at DESC NULLS LAST, created_at DESC NULLS LAST, {TIES}) = 1",
    "num": "SELECT * EXCLUDE (image_link) REPLACE (CAST(rank_date AS DATE) AS rank_date), "
    f"{metric('popularity')} AS numeric_popularity, {metric('read_count')} AS numeric_read_count, "
    f"{number('score')} AS numeric_score, {words('words_num')} AS numeric_words FROM uniq",
    "avgs": "SELECT " + ", ".join(f"coalesce(avg({m}), 0) AS a_{m}" for m in METRICS) + " FROM num",
    "filled": "SELECT num.* REPLACE (" + ", ".join(f"coalesce({m}, a_{m}) AS {m}" for m in METRICS) + ") FROM num, avgs",
    "quart": "SELECT quantile_cont(numeric_popularity, 0.25) AS q1, quantile_cont(numeric_popularity, 0.5) AS q2, "
    "quantile_cont(numeric_popularity, 0.75) AS q3 FROM filled",
    "capped": "SELECT filled.* REPLACE (CASE WHEN numeric_popularity < q1 - 3 * (q3 - q1) "
    "OR numeric_popularity > q3 + 3 * (q3 - q1) THEN q2 ELSE numeric_popularity END AS numeric_popularity) FROM filled, quart",
    "dwd": "SELECT * REPLACE (coalesce(category1_name, '未知') AS category1_name, coalesce(category2_name, '未知') AS category2_name, "
    "coalesce(status, '未知') AS status, coalesce(rank_name, '未知') AS rank_name, coalesce(gender_type, 'unknown') AS gender_type), "
    "CAST(1.0 AS DOUBLE) AS data_quality_score FROM capped",
    "cur": "SELECT * FROM dwd QUALIFY row_number() OVER (PARTITION BY book_id ORDER BY rank_date DESC) = 1",
}

HEAT = """
SELECT book_id, title, author, category1_name, category2_name, rank_name, rank_date, created_at, numeric_popularity,
  numeric_read_count, numeric_score, status, gender_type, prev_day_popularity, popularity_diff, popularity_growth_rate,
  prev_popularity_diff, popularity_acceleration, category_avg_growth_rate, is_new_book, is_high_growth,
  CASE WHEN is_new_book = 1 AND is_high_growth = 1 THEN 1 ELSE 0 END AS is_cold_start_quality,
  CASE WHEN numeric_popularity >= 1e7 THEN '爆款' WHEN numeric_popularity >= 1e6 THEN '热门'
       WHEN numeric_popularity >= 1e5 THEN '中等' ELSE '冷门' END AS heat_level
FROM (SELECT *, CASE WHEN date_diff('day', CAST(created_at AS DATE), rank_date) <= 7 THEN 1 ELSE 0 END AS is_new_book,
        CASE WHEN popularity_growth_rate > category_avg_growth_rate THEN 1 ELSE 0 END AS is_high_growth,
        row_number() OVER (PARTITION BY book_id ORDER BY rank_date DESC) AS rn
      FROM (SELECT *, avg(popularity_growth_rate) OVER (PARTITION BY category1_name) AS category_avg_growth_rate FROM momentum))
WHERE rn = 1"""
MOMENTUM = """
SELECT *, CASE WHEN prev_popularity_diff IS NULL THEN 0 ELSE popularity_diff - prev_popularity_diff END AS popularity_acceleration
FROM (SELECT *, lag(popularity_diff) OVER (PARTITION BY book_id ORDER BY rank_date) AS prev_popularity_diff
      FROM (SELECT *, CASE WHEN prev_day_popularity IS NULL THEN 0 ELSE numeric_popularity - prev_day_popularity END AS popularity_diff,
              CASE WHEN prev_day_popularity > 0 THEN (numeric_popularity - prev_day_popularity) / prev_day_popularity * 100 ELSE 0 END
                AS popularity_growth_rate
            FROM (SELECT *, lag(numeric_popularity) OVER (PARTITION BY book_id ORDER BY rank_date) AS prev_day_popularity FROM dwd)))"""
TREND = """
SELECT book_id, title, author, rank_name, category1_name, rank_date, numeric_popularity, numeric_read_count, numeric_score, status,
  gender_type, prev_read_count, read_count_growth, read_count_growth_rate, ranking_conversion_rate,
  CASE WHEN numeric_popularity > 1e6 AND read_count_growth_rate < 5 THEN 1 ELSE 0 END AS is_unworthy,
  CASE WHEN numeric_score >= 8 AND read_count_growth_rate > 20 THEN 1 ELSE 0 END AS is_high_conversion,
  numeric_score / 10 * 0.5 + (CASE WHEN ranking_conversion_rate > 0 THEN least(ranking_conversion_rate / 100, 1) ELSE 0 END) * 0.5
    AS recommend_weight
FROM (SELECT *, CASE WHEN numeric_popularity > 0 THEN read_count_growth / numeric_popularity * 100 ELSE 0 END AS ranking_conversion_rate,
        row_number() OVER (PARTITION BY book_id, rank_name ORDER BY rank_date DESC) AS rn
      FROM (SELECT *, CASE WHEN prev_read_count IS NULL THEN 0 ELSE numeric_read_count - prev_read_count END AS read_count_growth,
              CASE WHEN prev_read_count > 0 THEN (numeric_read_count - prev_read_count) / prev_read_count * 100 ELSE 0 END
                AS read_count_growth_rate
            FROM (SELECT *, lag(numeric_read_count) OVER (PARTITION BY book_id ORDER BY rank_date) AS prev_read_count FROM dwd)))
WHERE rn = 1"""


def titled(source: str) -> str:
    return f"""
SELECT *, CASE WHEN numeric_words < 200000 THEN '短篇(<20万)' WHEN numeric_words < 500000 THEN '中篇(20-50万)'
    WHEN numeric_words < 800000 THEN '长篇(50-80万)' WHEN numeric_words < 1500000 THEN '超长篇(80-150万)' ELSE '巨著(>150万)' END AS words_range,
  coalesce(length(title), 0) AS title_length, CASE WHEN regexp_matches(title, '{HOT_KEYWORDS}') THEN 1 ELSE 0 END AS has_hot_keywords,
  CASE WHEN numeric_words BETWEEN 500000 AND 800000 AND status = '连载中' THEN 1 ELSE 0 END AS is_golden_range
FROM {source}"""


REASON_KEYS = "category1_name, category2_name, words_range, status, has_hot_keywords, is_golden_range"
REASON = f"""
SELECT {REASON_KEYS}, count(book_id) AS book_count, avg(numeric_popularity) AS avg_popularity, avg(numeric_score) AS avg_score,
  avg(numeric_words) AS avg_words, CAST(0 AS DOUBLE) AS avg_intro_length, avg(title_length) AS avg_title_length,
  avg(numeric_popularity) / 1000000 AS heat_index
FROM ({titled("cur")}) GROUP BY {REASON_KEYS}"""
DECAY = """
SELECT *, CASE WHEN attenuation_rate >= 80 THEN 1 ELSE 0 END AS is_severe, CASE WHEN attenuation_rate BETWEEN 50 AND 80 THEN 1 ELSE 0 END AS is_moderate
FROM (SELECT *, CASE WHEN peak > 0 THEN (peak - numeric_popularity) / peak * 100 ELSE 0 END AS attenuation_rate,
        CASE WHEN prev > 0 THEN (prev - numeric_popularity) / prev * 100 ELSE 0 END AS attenuation_speed,
        date_diff('day', peak_day, rank_date) AS days_from_peak
      FROM (SELECT *, max(numeric_popularity) OVER (PARTITION BY book_id) AS peak,
              lag(numeric_popularity) OVER (PARTITION BY book_id ORDER BY rank_date) AS prev,
              first_value(rank_date) OVER (PARTITION BY book_id ORDER BY numeric_popularity DESC, rank_date) AS peak_day FROM dwd))"""
DECAY_KEYS = "book_id, title, author, category1_name, status, gender_type"
ATTENUATION = f"""
SELECT *, CASE WHEN total_attenuation < 20 THEN '稳定型' WHEN total_attenuation < 50 THEN '缓慢衰减'
    WHEN total_attenuation < 80 THEN '快速衰减' ELSE '断崖式衰减' END AS attenuation_type,
  CASE WHEN avg_attenuation_speed > 0 THEN 20 / avg_attenuation_speed ELSE 90 END AS recommended_new_book_days
FROM (SELECT *, CASE WHEN peak_popularity > 0 THEN (peak_popularity - lowest_popularity) / peak_popularity * 100 ELSE 0 END AS total_attenuation
      FROM (SELECT {DECAY_KEYS}, max(peak) AS peak_popularity, min(numeric_popularity) AS lowest_popularity,
              avg(attenuation_rate) AS avg_attenuation_rate, avg(attenuation_speed) AS avg_attenuation_speed,
              CAST(max(days_from_peak) AS INTEGER) AS lifecycle_days, avg(numeric_score) AS avg_score, max(is_severe) AS has_severe_attenuation
            FROM decay GROUP BY {DECAY_KEYS}))"""
RECOMMENDATION = """
SELECT *, CASE WHEN niche_recommendation_score >= 0.9 THEN '强烈推荐' WHEN niche_recommendation_score >= 0.8 THEN '推荐'
    WHEN niche_recommendation_score >= 0.7 THEN '可看' ELSE '一般' END AS recommendation_level
FROM (SELECT *, numeric_score / 10 * 0.7 + relative_heat / 5 * 0.3 AS niche_recommendation_score,
        CASE WHEN category_heat_rank <= 10 AND numeric_score >= 8.5 THEN 1 ELSE 0 END AS is_niche_hit,
        CASE WHEN numeric_score >= 9 AND numeric_popularity < 5e6 AND category_heat_rank <= 5 THEN 1 ELSE 0 END AS is_high_score_niche
      FROM (SELECT *, CASE WHEN category_avg_popularity > 0 THEN numeric_popularity / category_avg_popularity ELSE 0 END AS relative_heat
            FROM (SELECT book_id, title, author, category1_name, category2_name, gender_type, numeric_popularity, numeric_score,
                    numeric_read_count, status,
                    CAST(dense_rank() OVER (PARTITION BY category1_name, gender_type ORDER BY numeric_popularity DESC) AS INTEGER) AS category_heat_rank,
                    CAST(dense_rank() OVER (PARTITION BY category1_name, category2_name, gender_type ORDER BY numeric_popularity DESC) AS INTEGER)
                      AS subcategory_heat_rank,
                    avg(numeric_popularity) OVER (PARTITION BY category1_name, gender_type) AS category_avg_popularity FROM cur)))
WHERE category_heat_rank <= 20 OR numeric_score >= 8.5"""
PITFALLS = """
SELECT *, CASE WHEN is_suspicious_boost = 1 THEN '高风险' WHEN is_high_heat_low_score = 1 THEN '中风险'
    WHEN is_low_conversion = 1 THEN '低风险' ELSE '正常' END AS risk_level,
  CAST(CASE WHEN is_suspicious_boost = 1 THEN 0.3 WHEN is_high_heat_low_score = 1 THEN 0.5 WHEN is_low_conversion = 1 THEN 0.7 ELSE 1 END AS DOUBLE)
    AS recommendation_weight,
  CASE WHEN is_suspicious_boost = 1 THEN '强烈建议避开，疑似刷榜' WHEN is_high_heat_low_score = 1 THEN '谨慎阅读，评分较低'
    WHEN is_low_conversion = 1 THEN '注意，热度与实际阅读不符' ELSE '可正常阅读' END AS avoidance_advice
FROM (SELECT *, CASE WHEN numeric_popularity >= 5e6 AND numeric_score < 6 THEN 1 ELSE 0 END AS is_high_heat_low_score,
        CASE WHEN numeric_popularity >= 1e7 AND numeric_score < 5.5 THEN 1 ELSE 0 END AS is_suspicious_boost,
        CASE WHEN numeric_popularity >= 5e6 AND read_conversion < 10 THEN 1 ELSE 0 END AS is_low_conversion
      FROM (SELECT book_id, title, author, category1_name, category2_name, rank_name, gender_type, numeric_popularity, numeric_score,
              numeric_read_count, rank_date,
              CASE WHEN numeric_score > 0 THEN numeric_popularity / numeric_score / 100000 ELSE 0 END AS heat_score_ratio,
              CASE WHEN numeric_popularity > 0 THEN numeric_read_count / numeric_popularity * 100 ELSE 0 END AS read_conversion FROM cur))"""


def totals(source: str) -> str:
    return f"""
SELECT book_id, title, author, category1_name, category2_name, status, gender_type, sum(numeric_popularity) AS total_heat_integral,
  avg(numeric_popularity) AS avg_popularity, max(numeric_popularity) AS peak_popularity, min(numeric_popularity) AS lowest_popularity,
  count(*) AS appearance_count, min(rank_date) AS first_rank_date, max(rank_date) AS latest_rank_date, avg(numeric_score) AS avg_score,
  avg(numeric_read_count) AS avg_read_count, avg(numeric_words) AS total_words
FROM {source} GROUP BY book_id, title, author, category1_name, category2_name, status, gender_type"""


def ltv(source: str) -> str:
    return f"""
SELECT *, CASE WHEN ltv_score >= 10 THEN 'SSS级' WHEN ltv_score >= 5 THEN 'SS级' WHEN ltv_score >= 2 THEN 'S级' WHEN ltv_score >= 1 THEN 'A级'
    WHEN ltv_score >= 0.5 THEN 'B级' ELSE 'C级' END AS ip_value_level,
  CASE ip_type WHEN '短线爆款' THEN '适合短剧、网络电影' WHEN '长线稳定' THEN '适合影视剧、动漫、游戏' WHEN '波动型' THEN '适合短期营销炒作'
    ELSE '需持续观察' END AS adaptation_suggestion
FROM (SELECT *, CASE WHEN heat_volatility > 3 AND lifecycle_days < 30 THEN '短线爆款' WHEN heat_volatility <= 2 AND lifecycle_days >= 90 THEN '长线稳定'
        WHEN heat_volatility > 2 THEN '波动型' ELSE '成长型' END AS ip_type,
        total_heat_integral / 10000000 * 0.4 + lifecycle_days / 365 * 0.3 + avg_score / 10 * 0.2 + heat_stability * 0.1 AS ltv_score
      FROM (SELECT *, CASE WHEN lifecycle_days > 0 THEN total_heat_integral / lifecycle_days ELSE avg_popularity END AS daily_avg_heat,
              CASE WHEN avg_popularity > 0 THEN peak_popularity / avg_popularity ELSE 0 END AS heat_volatility,
              CASE WHEN avg_popularity > 0 THEN lowest_popularity / avg_popularity ELSE 0 END AS heat_stability
            FROM (SELECT *, CAST(date_diff('day', first_rank_date, latest_rank_date) + 1 AS INTEGER) AS lifecycle_days FROM ({totals(source)}))))"""


PAYING = """
SELECT *, CASE WHEN fan_quality_index >= 100 THEN '极强' WHEN fan_quality_index >= 50 THEN '强' WHEN fan_quality_index >= 20 THEN '中等'
    ELSE '弱' END AS fan_stickiness_level,
  CASE WHEN is_high_arpu = 1 AND numeric_score >= 8 THEN '优质资本标的' WHEN is_high_arpu = 1 THEN '高付费潜力'
    WHEN arpu_indicator > 20 THEN '中等付费潜力' ELSE '一般' END AS purchasing_power_rating
FROM (SELECT *, CASE WHEN is_payment_rank = 1 AND rank_number <= 50 THEN arpu_indicator * 1.5 ELSE arpu_indicator END AS fan_quality_index,
        CASE WHEN arpu_indicator > 50 AND is_payment_rank = 1 THEN 1 ELSE 0 END AS is_high_arpu
      FROM (SELECT *, CASE WHEN numeric_read_count > 0 THEN numeric_popularity / numeric_read_count ELSE 0 END AS arpu_indicator,
              CASE WHEN regexp_matches(rank_name, '打赏|月票|畅销|VIP') THEN 1 ELSE 0 END AS is_payment_rank,
              coalesce(CAST(number AS DOUBLE), 999) AS rank_number FROM dwd))"""
POWER_KEYS = "book_id, title, author, category1_name, gender_type"
POWER = f"""
SELECT *, CASE WHEN fan_value_score >= 2 THEN 'S级' WHEN fan_value_score >= 1 THEN 'A级' WHEN fan_value_score >= 0.5 THEN 'B级' ELSE 'C级' END
    AS investment_value_level,
  CASE WHEN is_high_arpu_book = 1 AND avg_score >= 8 THEN '强烈推荐-高付费+高质量' WHEN is_high_arpu_book = 1 THEN '推荐-高付费潜力'
    WHEN avg_fan_quality >= 50 THEN '可考虑-粉丝粘性强' ELSE '观望' END AS investment_recommendation
FROM (SELECT *, avg_arpu / 100 * 0.5 + avg_fan_quality / 100 * 0.3 + avg_score / 10 * 0.2 AS fan_value_score
      FROM (SELECT {POWER_KEYS}, avg(arpu_indicator) AS avg_arpu, max(arpu_indicator) AS max_arpu, avg(fan_quality_index) AS avg_fan_quality,
              max(is_payment_rank) AS has_payment_rank, max(is_high_arpu) AS is_high_arpu_book, avg(numeric_score) AS avg_score,
              avg(numeric_read_count) AS avg_read_count, avg(numeric_popularity) AS avg_popularity, count(*) AS appearance_count
            FROM paying GROUP BY {POWER_KEYS}))"""

CTES |= {
    "momentum": MOMENTUM,
    "heat": HEAT,
    "trend": TREND,
    "reason": REASON,
    "decay": DECAY,
    "attenuation": ATTENUATION,
    "recommendation": RECOMMENDATION,
    "pitfalls": PITFALLS,
    "ltv": ltv("dwd"),
    "paying": PAYING,
    "power": POWER,
    "crawled": "SELECT 'B' || l_partkey AS book_id, CASE WHEN l_partkey % 19 = 0 THEN '?' WHEN l_linenumber % 2 = 0 THEN '男生' ELSE '女生' END AS gender, "
    "CASE l_orderkey % 5 WHEN 0 THEN '大热' WHEN 1 THEN '新书' WHEN 2 THEN '完结' WHEN 3 THEN '收藏' ELSE '更新' END AS rank_name, "
    "CASE WHEN l_orderkey % 5 >= 3 THEN '' ELSE strftime(o_orderdate, '%Y%m') END AS date_month, CAST(ceil(l_quantity / 10) AS INTEGER) AS page, "
    "CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS number, l_orderkey % 23 = 0 AS error, l_shipdate AS arrival, l_orderkey AS request, "
    "CAST(trunc(l_extendedprice) AS BIGINT) AS response_size FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "user_daily": "SELECT user_id, CAST(ts AS DATE) AS d, sum(value) AS metric FROM events GROUP BY ALL",
    "favourite": "SELECT user_id, event_type AS category FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) "
    "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) = 1",
    "users": "SELECT CAST(user_id AS VARCHAR) AS book_id, 'user ' || user_id AS title, category AS author, category AS category1_name, "
    "'all' AS category2_name, 'daily' AS rank_name, '连载中' AS status, 'unknown' AS gender_type, d AS rank_date, CAST(d AS TIMESTAMP) AS created_at, "
    "round(metric, 2) * 100000 AS numeric_popularity, round(metric, 2) * 1000 AS numeric_read_count, CAST(7.5 AS DOUBLE) AS numeric_score, "
    "CAST(600000 AS DOUBLE) AS numeric_words FROM user_daily JOIN favourite USING (user_id)",
}

# What each expression reads directly.
READS = {
    "ods": ["obs"],
    "valid": ["ods"],
    "uniq": ["valid"],
    "num": ["uniq"],
    "avgs": ["num"],
    "filled": ["num", "avgs"],
    "quart": ["filled"],
    "capped": ["filled", "quart"],
    "dwd": ["capped"],
    "cur": ["dwd"],
    "momentum": ["dwd"],
    "heat": ["momentum"],
    "trend": ["dwd"],
    "reason": ["cur"],
    "decay": ["dwd"],
    "attenuation": ["decay"],
    "recommendation": ["cur"],
    "pitfalls": ["cur"],
    "ltv": ["dwd"],
    "paying": ["dwd"],
    "power": ["paying"],
    "users": ["user_daily", "favourite"],
}

ORACLE: dict[str, str] = {}


def _needed(names: list[str]) -> list[str]:
    found: set[str] = set()

    def visit(name: str) -> None:
        if name not in found:
            for read in READS.get(name, []):
                visit(read)
            found.add(name)

    for name in names:
        visit(name)
    return [name for name in CTES if name in found]


def oracle(key: str, uses: str, sql: str, doubles: str = "", extra: dict[str, str] | None = None) -> None:
    """Register a statement. ``uses`` names the common expressions, ``doubles`` the columns compared in single precision."""
    chain = [f"{name} AS MATERIALIZED ({CTES[name]})" for name in _needed(uses.split())]
    chain += [f"{name} AS ({body})" for name, body in (extra or {}).items()]
    replaced = []
    for c in doubles.split():
        single = f"CAST(CAST({c} AS FLOAT) AS DOUBLE)"
        replaced.append(f"CASE WHEN {single} = 0 THEN CAST(0 AS DOUBLE) ELSE {single} END AS {c}")
    outer = f"SELECT * REPLACE ({', '.join(replaced)}) FROM ({sql}) result" if replaced else sql
    ORACLE[key] = (f"WITH {', '.join(chain)} " if chain else "") + outer


ALL = " ".join(METRICS)
COLS = ", ".join(METRICS)

# --- sources and sinks ------------------------------------------------------------------------------------------
oracle("src_layer_table", "dwd", f"SELECT book_id, rank_date, rank_name, {COLS} FROM dwd", ALL)
oracle("sink_layer_write", "ods", "SELECT book_id, title, rank_date, popularity, count(*) OVER () AS rows_written FROM ods")
oracle(
    "sink_layer_append",
    "ods",
    "SELECT date_month, count(*) AS row_count, CAST(sum(CAST(number AS INTEGER)) AS BIGINT) AS number_sum FROM ods GROUP BY date_month",
)
oracle(
    "sink_verify_export",
    "cur",
    "SELECT CAST(i AS INTEGER) AS position, ['book_id', 'title', 'author', 'category1_name', 'category2_name'][i] AS column_name, "
    "'string' AS data_type, (SELECT count(*) FROM cur) AS row_count FROM range(1, 6) t(i)",
)
oracle("sink_json", "ods", "SELECT book_id, title, author, words_num, status, number, unit, rank_name, score FROM ods")
_COUNTS = {
    "ods_rank_facts": "ods",
    "dwd_rank_facts": "dwd",
    "dwd_newest_facts": "cur",
    "ads_platform_heat": "heat",
    "ads_platform_ranking_trend": "trend",
    "ads_author_reason": "reason",
    "ads_author_attenuation_effect": "attenuation",
    "ads_user_layered_recommendation": "recommendation",
    "ads_user_avoid_pitfalls": "pitfalls",
    "ads_capital_ltv": "ltv",
    "ads_capital_future_purchasing_power": "power",
}
oracle(
    "layers_run",
    "ods dwd cur heat trend reason attenuation recommendation pitfalls ltv power",
    " UNION ALL ".join(f'SELECT \'{name}\' AS layer, true AS ok, (SELECT count(*) FROM {cte}) AS "rows"' for name, cte in _COUNTS.items()),
)

oracle(
    "src_sample",
    "dwd",
    "SELECT book_id, rank_date, numeric_popularity FROM dwd WHERE CAST('0x' || substr(md5(coalesce(book_id, '') || '|0'), 1, 13) AS BIGINT) "
    f"< {int(0.1 * 16**13)}",
    "numeric_popularity",
)
_RULES = {
    "no_key": "coalesce(book_id, title, author) IS NOT NULL",
    "bad_id": "coalesce(NOT regexp_matches(book_id, '^https?://'), false)",
    "bad_date": "coalesce(regexp_matches(rank_date, '^[0-9]{4}-[0-9]{2}-[0-9]{2}$') AND TRY_CAST(rank_date AS DATE) IS NOT NULL, false)",
    "bad_title": "coalesce(title NOT IN ('0', '1'), false)",
}
oracle(
    "layers_removed",
    "ods valid uniq",
    "SELECT 'dwd_rank_facts' AS layer, (SELECT count(*) FROM uniq) AS \"rows\", "
    + ", ".join(
        f"count(*) FILTER (WHERE {' AND '.join([*(f'({r})' for r in list(_RULES.values())[:i]), f'NOT ({rule})'])}) AS removed_{reason}"
        for i, (reason, rule) in enumerate(_RULES.items())
    )
    + ", (SELECT count(*) FROM valid) - (SELECT count(*) FROM uniq) AS removed_duplicate FROM ods",
)
oracle(
    "ads_from_totals",
    "ltv attenuation power",
    "SELECT l.book_id, l.title, l.category2_name, l.status, l.total_heat_integral, l.appearance_count, l.ltv_score, l.ip_type, a.total_attenuation, "
    "a.avg_attenuation_speed, a.lifecycle_days, a.attenuation_type, p.avg_arpu, p.max_arpu, p.fan_value_score, p.investment_value_level "
    "FROM ltv l JOIN attenuation a ON l.book_id = a.book_id AND l.title = a.title AND l.status = a.status JOIN power p ON l.book_id = p.book_id AND l.title = p.title",
    "total_heat_integral ltv_score total_attenuation avg_attenuation_speed avg_arpu max_arpu fan_value_score",
)
oracle("layers_append", "dwd", f"SELECT book_id, rank_date, rank_name, status, {COLS} FROM dwd", ALL)

# --- cleaning ---------------------------------------------------------------------------------------------------
oracle("clean_drop_column", "obs", "SELECT book_id, author, rank_date FROM obs")
oracle("clean_newlines", "ods", "SELECT book_id, title, rank_date FROM ods")
oracle("clean_drop_empty_columns", "ods", "SELECT book_id, date_type, date_month, number FROM ods")
oracle(
    "clean_any_key_present",
    "ods",
    "SELECT book_id, CASE WHEN who IS NULL THEN NULL ELSE title END AS title, who AS author, rank_date FROM "
    "(SELECT *, CASE WHEN book_id IS NULL AND number < '3' THEN NULL ELSE author END AS who FROM ods) "
    "WHERE book_id IS NOT NULL OR who IS NOT NULL",
)
oracle("clean_bad_keys", "ods", f"SELECT book_id, rank_date, title FROM ods WHERE {GOOD_KEYS}")
oracle("clean_status_decode", "ods", f"SELECT book_id, rank_date, {STATUS} AS status FROM ods")
oracle("clean_invalid_titles", "ods", "SELECT book_id, rank_date, title FROM ods WHERE title NOT IN ('0', '1')")
oracle(
    "clean_unit_parse",
    "ods",
    f"SELECT popularity AS popularity_text, {metric('popularity')} AS numeric_popularity, read_count AS read_count_text, "
    f"{metric('read_count')} AS numeric_read_count FROM ods",
    "numeric_popularity numeric_read_count",
)
oracle("clean_score_parse", "ods", f"SELECT book_id, score AS score_text, {number('score')} AS numeric_score FROM ods", "numeric_score")
oracle("clean_words_parse", "ods", f"SELECT book_id, words_num, {words('words_num')} AS numeric_words FROM ods", "numeric_words")
oracle("clean_mean_fill", "filled", f"SELECT book_id, rank_date, {COLS} FROM filled", ALL)
oracle("clean_iqr_cap", "capped", "SELECT book_id, rank_date, numeric_popularity FROM capped", "numeric_popularity")
oracle(
    "clean_fill_labels",
    "ods",
    "SELECT book_id, rank_date, coalesce(category1_name, '未知') AS category1_name, coalesce(category2_name, '未知') AS category2_name, "
    "coalesce(status, '未知') AS status, coalesce(rank_name, '未知') AS rank_name, coalesce(gender_type, 'unknown') AS gender_type FROM ods",
)
_PARSED = f"{metric('popularity')} AS p, {metric('read_count')} AS r, {number('score')} AS s"
oracle(
    "clean_quality_score",
    "ods",
    "SELECT book_id, rank_date, CAST(CASE WHEN p IS NOT NULL AND r IS NOT NULL AND s IS NOT NULL THEN 1 ELSE 0.5 END AS DOUBLE) "
    f"AS data_quality_score FROM (SELECT book_id, rank_date, {_PARSED} FROM ods)",
    "data_quality_score",
)
oracle("clean_all", "dwd", "SELECT * FROM dwd", ALL + " data_quality_score")

# --- aggregates -------------------------------------------------------------------------------------------------
oracle("agg_global_means", "dwd", "SELECT " + ", ".join(f"avg({m}) AS {m}" for m in METRICS) + " FROM dwd", ALL)
oracle(
    "agg_global_quartiles",
    "dwd",
    " UNION ALL ".join(
        f"SELECT '{m}' AS metric_name, quantile_cont({m}, 0.25) AS q1, quantile_cont({m}, 0.5) AS median, quantile_cont({m}, 0.75) AS q3 FROM dwd"
        for m in METRICS[:3]
    ),
    "q1 median q3",
)
oracle(
    "agg_feature_groups",
    "dwd",
    f"SELECT * EXCLUDE (heat_index) FROM ({REASON.replace(titled('cur'), titled('dwd'))})",
    "avg_popularity avg_score avg_words avg_intro_length avg_title_length",
)
oracle(
    "agg_attenuation",
    "decay",
    f"SELECT * EXCLUDE (total_attenuation, attenuation_type, recommended_new_book_days) FROM ({ATTENUATION})",
    "peak_popularity lowest_popularity avg_attenuation_rate avg_attenuation_speed avg_score",
)
_TOTAL_DOUBLES = "total_heat_integral avg_popularity peak_popularity lowest_popularity avg_score avg_read_count total_words"
oracle("agg_ltv", "dwd", totals("dwd"), _TOTAL_DOUBLES)
oracle(
    "agg_purchasing",
    "power",
    "SELECT * EXCLUDE (fan_value_score, investment_value_level, investment_recommendation) FROM power",
    "avg_arpu max_arpu avg_fan_quality avg_score avg_read_count avg_popularity",
)

# --- windows ----------------------------------------------------------------------------------------------------
oracle("win_dedup_latest", "uniq", "SELECT book_id, rank_date, popularity, score, updated_at FROM uniq")
oracle("win_latest_per_entity", "cur", f"SELECT book_id, rank_date, rank_name, status, {COLS} FROM cur", ALL)
oracle(
    "win_latest_per_entity_list",
    "dwd",
    "SELECT book_id, rank_name, rank_date, numeric_popularity FROM dwd "
    "QUALIFY row_number() OVER (PARTITION BY book_id, rank_name ORDER BY rank_date DESC) = 1",
    "numeric_popularity",
)
for _key, _metric, _name in (
    ("win_lag_popularity", "numeric_popularity", "prev_day_popularity"),
    ("win_lag_read_count", "numeric_read_count", "prev_read_count"),
):
    oracle(
        _key,
        "dwd",
        f"SELECT book_id, rank_date, {_metric}, lag({_metric}) OVER (PARTITION BY book_id ORDER BY rank_date) AS {_name} FROM dwd",
        f"{_metric} {_name}",
    )
oracle(
    "win_lag_of_lag",
    "momentum",
    "SELECT book_id, rank_date, popularity_diff, prev_popularity_diff, popularity_acceleration FROM momentum",
    "popularity_diff prev_popularity_diff popularity_acceleration",
)
oracle(
    "win_category_avg",
    "momentum",
    "SELECT book_id, rank_date, category1_name, popularity_growth_rate, avg(popularity_growth_rate) OVER (PARTITION BY category1_name) "
    "AS category_avg_growth_rate FROM momentum",
    "popularity_growth_rate category_avg_growth_rate",
)
oracle(
    "win_peak",
    "dwd",
    "SELECT book_id, rank_date, numeric_popularity, max(numeric_popularity) OVER (PARTITION BY book_id) AS peak_popularity FROM dwd",
    "numeric_popularity peak_popularity",
)
oracle(
    "win_peak_date",
    "dwd",
    "SELECT book_id, rank_date, numeric_popularity, first_value(rank_date) OVER (PARTITION BY book_id ORDER BY numeric_popularity DESC, rank_date) "
    "AS peak_date FROM dwd",
    "numeric_popularity",
)
oracle(
    "win_history_appended",
    "momentum",
    "SELECT book_id, rank_date, numeric_popularity, prev_day_popularity, popularity_diff, popularity_growth_rate, prev_popularity_diff, "
    "popularity_acceleration, max(numeric_popularity) OVER (PARTITION BY book_id) AS peak_popularity, "
    "first_value(rank_date) OVER (PARTITION BY book_id ORDER BY numeric_popularity DESC, rank_date) AS peak_date FROM momentum",
    "numeric_popularity prev_day_popularity popularity_diff popularity_growth_rate prev_popularity_diff popularity_acceleration peak_popularity",
)
_CUR = "SELECT book_id, category1_name, category2_name, gender_type, numeric_popularity"
oracle(
    "win_dense_rank",
    "cur",
    f"{_CUR}, CAST(dense_rank() OVER (PARTITION BY category1_name, gender_type ORDER BY numeric_popularity DESC) AS INTEGER) AS category_heat_rank FROM cur",
    "numeric_popularity",
)
oracle(
    "win_dense_rank_sub",
    "cur",
    f"{_CUR}, CAST(dense_rank() OVER (PARTITION BY category1_name, category2_name, gender_type ORDER BY numeric_popularity DESC) AS INTEGER) "
    "AS subcategory_heat_rank FROM cur",
    "numeric_popularity",
)
oracle(
    "win_group_avg",
    "cur",
    f"{_CUR}, avg(numeric_popularity) OVER (PARTITION BY category1_name, gender_type) AS group_avg FROM cur",
    "numeric_popularity group_avg",
)

# --- scalar functions -------------------------------------------------------------------------------------------
oracle(
    "scalar_functions",
    "ods",
    "SELECT book_id, contains(popularity, '万') AS has_unit, regexp_replace(title, '[aeiou]', '_', 'g') AS title_masked, "
    "regexp_matches(book_id, '^https?://') AS is_url, CAST(length(title) AS INTEGER) AS title_length, title LIKE '%red%' AS title_like, "
    "CAST(date_diff('day', CAST(created_at AS DATE), day) AS INTEGER) AS age_days, strftime(day, '%Y-%m-%d') AS day_text, "
    "CASE WHEN value IS NULL THEN CAST(0.75 AS DOUBLE) ELSE least(value / 10, 0.75) END AS capped, round(value / 3, 2) AS rounded_two, "
    "round(value / 7, 4) AS rounded_four, CASE WHEN value BETWEEN 6 AND 8 THEN 1 ELSE 0 END AS is_middle, "
    "CASE WHEN status IN ('0', '1') THEN 1 ELSE 0 END AS is_code, "
    f"{metric('read_count')} AS read_value, {words('words_num')} AS words_value, CAST(0 AS DOUBLE) AS no_change, "
    "(value - 8) / 8 * 100 AS from_eight, CAST(strptime(date_month || '01', '%Y%m%d') AS DATE) AS month_day "
    f"FROM (SELECT *, {number('score')} AS value, TRY_CAST(rank_date AS DATE) AS day FROM ods)",
    "capped rounded_two rounded_four read_value words_value no_change from_eight",
)

# --- feature tables ---------------------------------------------------------------------------------------------
_PRS = "numeric_popularity numeric_read_count numeric_score"
oracle(
    "ads_platform_heat",
    "heat",
    "SELECT * FROM heat",
    f"{_PRS} prev_day_popularity popularity_diff popularity_growth_rate prev_popularity_diff popularity_acceleration category_avg_growth_rate",
)
oracle(
    "ads_platform_ranking_trend",
    "trend",
    "SELECT * FROM trend",
    f"{_PRS} prev_read_count read_count_growth read_count_growth_rate ranking_conversion_rate recommend_weight",
)
oracle("ads_author_reason", "reason", "SELECT * FROM reason", "avg_popularity avg_score avg_words avg_intro_length avg_title_length heat_index")
oracle(
    "ads_author_attenuation_effect",
    "decay",
    ATTENUATION,
    "peak_popularity lowest_popularity avg_attenuation_rate avg_attenuation_speed avg_score total_attenuation recommended_new_book_days",
)
oracle(
    "ads_user_layered_recommendation",
    "recommendation",
    "SELECT * FROM recommendation",
    f"{_PRS} category_avg_popularity relative_heat niche_recommendation_score",
)
oracle(
    "ads_user_avoid_pitfalls",
    "pitfalls",
    "SELECT * FROM pitfalls",
    f"{_PRS} heat_score_ratio read_conversion recommendation_weight",
)
oracle(
    "ads_capital_ltv",
    "ltv",
    "SELECT * FROM ltv",
    f"{_TOTAL_DOUBLES} daily_avg_heat heat_volatility heat_stability ltv_score",
)
_POWER_DOUBLES = "avg_arpu max_arpu avg_fan_quality avg_score avg_read_count avg_popularity fan_value_score"
oracle("ads_capital_future_purchasing_power", "power", "SELECT * FROM power", _POWER_DOUBLES)
oracle(
    "ads_all",
    "heat trend reason attenuation recommendation pitfalls ltv power",
    " UNION ALL ".join(
        f"SELECT '{name}' AS feature, (SELECT count(*) FROM {cte}) AS row_count" for name, cte in _COUNTS.items() if name.startswith("ads_")
    ),
)
oracle(
    "row_purchasing_labels",
    "paying",
    "SELECT book_id, rank_date, rank_number, fan_quality_index, is_high_arpu, fan_stickiness_level, purchasing_power_rating FROM paying",
    "rank_number fan_quality_index",
)
_USER_MOMENTUM = MOMENTUM.replace("FROM dwd", "FROM users")
oracle(
    "events_heat",
    "users",
    "SELECT book_id, category1_name, rank_date, popularity_diff, popularity_acceleration, is_new_book, heat_level FROM user_heat",
    "popularity_diff popularity_acceleration",
    {"momentum": _USER_MOMENTUM, "user_heat": HEAT},
)
oracle(
    "events_ltv",
    "users",
    f"SELECT book_id, appearance_count, lifecycle_days, total_heat_integral, heat_volatility, ip_type, adaptation_suggestion FROM ({ltv('users')})",
    "total_heat_integral heat_volatility",
)

# --- dashboard --------------------------------------------------------------------------------------------------
oracle(
    "q_heat_growth_top",
    "heat",
    "SELECT book_id, title, numeric_popularity AS current_heat, prev_day_popularity AS previous_heat, round(popularity_growth_rate, 4) AS growth_rate "
    "FROM heat ORDER BY popularity_growth_rate DESC, book_id LIMIT 10",
    "current_heat previous_heat growth_rate",
)
oracle(
    "q_new_book_trend",
    "heat",
    "SELECT strftime(rank_date, '%Y-%m-%d') AS date, round(avg(numeric_popularity), 2) AS avg_heat FROM heat "
    "WHERE is_new_book = 1 AND numeric_popularity <> 0 GROUP BY rank_date",
    "avg_heat",
)
oracle(
    "q_category_avg_heat",
    "reason",
    "SELECT category1_name AS category, coalesce(round(avg(avg_popularity), 2), 0) AS avg_heat FROM reason GROUP BY category1_name",
    "avg_heat",
)
oracle(
    "q_wordcount_vs_heat",
    "ltv",
    "SELECT total_words AS word_count, avg_popularity AS heat FROM ltv WHERE total_words <> 0 AND avg_popularity <> 0",
    "word_count heat",
)
oracle(
    "q_status_heat_compare",
    "ltv",
    "SELECT status, coalesce(round(avg(avg_popularity), 2), 0) AS avg_heat FROM ltv WHERE status <> '' GROUP BY status",
    "avg_heat",
)
oracle(
    "q_top_books",
    "recommendation",
    "SELECT book_id, title, category1_name AS category, numeric_popularity AS current_heat, numeric_score AS score FROM recommendation "
    "ORDER BY numeric_popularity DESC, book_id LIMIT 5",
    "current_heat score",
)
oracle("q_categories", "recommendation", "SELECT DISTINCT category1_name FROM recommendation")
oracle(
    "q_high_heat_low_score",
    "pitfalls",
    "SELECT book_id, title, numeric_popularity AS heat, numeric_score AS score, avoidance_advice AS advice FROM pitfalls WHERE is_high_heat_low_score = 1",
    "heat score",
)
oracle(
    "q_ip_value_top",
    "ltv",
    "SELECT book_id, title, round(ltv_score, 2) AS ip_value, ip_value_level, total_heat_integral FROM ltv ORDER BY ltv_score DESC, book_id, status LIMIT 10",
    "ip_value total_heat_integral",
)
oracle(
    "q_payment_power",
    "power",
    "SELECT book_id, title, avg_arpu AS arpu, avg_fan_quality AS fan_quality, investment_value_level AS level FROM power",
    "arpu fan_quality",
)

# --- documented reports and features ----------------------------------------------------------------------------
oracle(
    "doc_heat_surge_top",
    "heat",
    "SELECT book_id, title, category1_name, popularity_diff, popularity_acceleration, rank_date FROM heat "
    "WHERE popularity_growth_rate >= 50 AND rank_date = (SELECT max(rank_date) FROM heat) ORDER BY popularity_acceleration DESC, book_id LIMIT 10",
    "popularity_diff popularity_acceleration",
)
oracle(
    "doc_unworthy_report",
    "trend",
    "SELECT book_id, title, rank_name, ranking_conversion_rate, recommend_weight FROM trend WHERE is_unworthy = 1 AND ranking_conversion_rate < 0.3 "
    "ORDER BY recommend_weight, book_id, rank_name LIMIT 20",
    "ranking_conversion_rate recommend_weight",
)
oracle(
    "doc_niche_hits",
    "recommendation",
    "SELECT book_id, title, category1_name, gender_type, relative_heat, numeric_score, niche_recommendation_score FROM recommendation "
    "WHERE is_niche_hit = 1 AND gender_type = 'male' AND category1_name = 'ECONOMY' ORDER BY niche_recommendation_score DESC, book_id LIMIT 10",
    "relative_heat numeric_score niche_recommendation_score",
)
oracle(
    "doc_ip_investment",
    "ltv",
    "SELECT book_id, title, author, ltv_score, ip_value_level, adaptation_suggestion, total_heat_integral, lifecycle_days FROM ltv "
    "WHERE ip_value_level IN ('S级', 'A级') AND adaptation_suggestion LIKE '%适合影视剧、动漫、游戏%' ORDER BY ltv_score DESC, book_id, status LIMIT 20",
    "ltv_score total_heat_integral",
)
oracle(
    "doc_high_arpu_fans",
    "power",
    "SELECT book_id, title, avg_arpu, fan_value_score, investment_value_level, investment_recommendation FROM power "
    "WHERE investment_value_level = 'S级' AND avg_arpu > 50 ORDER BY fan_value_score DESC, book_id LIMIT 15",
    "avg_arpu fan_value_score",
)
oracle(
    "doc_dwd_profile",
    "dwd",
    "SELECT count(*) AS row_count, avg(numeric_popularity) AS avg_popularity, avg(numeric_score) AS avg_score FROM dwd",
    "avg_popularity avg_score",
)
oracle(
    "custom_feature_roi",
    "dwd",
    "SELECT book_id, title, author, numeric_popularity AS popularity, numeric_read_count AS read_count, numeric_score AS score, "
    "CASE WHEN numeric_read_count > 0 THEN numeric_popularity / numeric_read_count ELSE 0 END AS roi_score FROM dwd",
    "popularity read_count score roi_score",
)
oracle(
    "doc_ranking_stability",
    "dwd",
    "SELECT book_id, rank_name, count(n) AS observations, CASE WHEN avg(n) > 0 THEN 1 - stddev_pop(n) / avg(n) END AS ranking_stability "
    "FROM (SELECT book_id, rank_name, CAST(number AS DOUBLE) AS n FROM dwd) GROUP BY book_id, rank_name",
    "ranking_stability",
)
oracle(
    "doc_days_since_completion",
    "dwd",
    "SELECT book_id, rank_date, status, CAST(date_diff('day', min(CASE WHEN status = '已完结' THEN rank_date END) OVER (PARTITION BY book_id), "
    "rank_date) AS INTEGER) AS days_since_completion FROM dwd",
)
oracle(
    "doc_category_avg_heat",
    "reason cur",
    f"SELECT {', '.join('r.' + c.strip() for c in REASON_KEYS.split(','))}, r.avg_popularity, c.category_avg_heat FROM reason r JOIN "
    "(SELECT category1_name, avg(numeric_popularity) AS category_avg_heat FROM cur GROUP BY category1_name) c ON r.category1_name = c.category1_name",
    "avg_popularity category_avg_heat",
)
oracle(
    "doc_ltv_log",
    "ltv",
    "SELECT book_id, title, status, total_heat_integral, lifecycle_days, total_heat_integral * (1 + log10(lifecycle_days)) AS ltv_log_score FROM ltv",
    "total_heat_integral ltv_log_score",
)
oracle(
    "doc_risk_rules",
    "pitfalls",
    "SELECT book_id, title, numeric_popularity, numeric_score, CASE WHEN numeric_popularity > 3000000 AND numeric_score < 6 THEN '高风险' "
    "WHEN numeric_popularity > 1000000 AND numeric_score < 7 THEN '可疑' ELSE '正常' END AS documented_risk FROM pitfalls",
    "numeric_popularity numeric_score",
)
oracle(
    "doc_keyword_lift",
    "cur",
    "SELECT category2_name, count(*) AS book_count, CAST(sum(k) AS BIGINT) AS keyword_books, avg(numeric_popularity) AS category_avg, "
    "avg(CASE WHEN k = 1 THEN numeric_popularity END) AS keyword_avg, "
    "avg(CASE WHEN k = 1 THEN numeric_popularity END) / avg(numeric_popularity) - 1 AS keyword_lift "
    f"FROM (SELECT *, CASE WHEN regexp_matches(title, '{HOT_KEYWORDS}') THEN 1 ELSE 0 END AS k FROM cur) GROUP BY category2_name",
    "category_avg keyword_avg keyword_lift",
)
oracle(
    "doc_words_regression",
    "cur",
    "SELECT category1_name, feature, count(*) AS book_count, regr_slope(numeric_popularity, x) AS slope, "
    "CASE WHEN min(x) < max(x) AND min(numeric_popularity) < max(numeric_popularity) THEN corr(numeric_popularity, x) END AS correlation "
    "FROM (SELECT category1_name, numeric_popularity, f.feature, CAST(CASE f.feature WHEN 'numeric_words' THEN numeric_words WHEN 'title_length' THEN title_length "
    f"ELSE has_hot_keywords END AS DOUBLE) AS x FROM ({titled('cur')}) t, (VALUES ('numeric_words'), ('title_length'), ('has_hot_keywords')) f(feature)) "
    "GROUP BY category1_name, feature",
    "slope correlation",
)
oracle(
    "doc_heat_trapezoid",
    "dwd",
    "SELECT book_id, coalesce(sum((numeric_popularity + pp) / 2 * date_diff('day', pd, rank_date)), 0) AS heat_area, count(*) AS observations FROM "
    "(SELECT *, lag(numeric_popularity) OVER w AS pp, lag(rank_date) OVER w AS pd FROM dwd WINDOW w AS (PARTITION BY book_id ORDER BY rank_date)) "
    "GROUP BY book_id",
    "heat_area",
)
oracle(
    "rule_author_levels",
    "dwd",
    "SELECT author, book_count, CASE WHEN book_count <= 1 THEN '新人作家' WHEN book_count <= 4 THEN '新锐作家' WHEN book_count <= 9 THEN '资深作家' "
    "ELSE '高产作家' END AS author_level FROM (SELECT author, count(DISTINCT book_id) AS book_count FROM dwd GROUP BY author)",
)
oracle(
    "rule_ip_levels",
    "ltv",
    "SELECT book_id, status, ltv_score, CASE WHEN ltv_score < 5 THEN 'C级' WHEN ltv_score < 10 THEN 'B级' WHEN ltv_score < 20 THEN 'A级' "
    "WHEN ltv_score < 50 THEN 'S级' WHEN ltv_score < 100 THEN 'SS级' ELSE 'SSS级' END AS ip_potential_level FROM ltv",
    "ltv_score",
)
oracle(
    "rule_heat_levels",
    "dwd",
    "SELECT heat_level, count(*) AS row_count FROM (SELECT CASE WHEN numeric_popularity < 100000 THEN '冷门' WHEN numeric_popularity < 1000000 THEN '中等' "
    "WHEN numeric_popularity < 10000000 THEN '热门' ELSE '爆款' END AS heat_level FROM dwd) GROUP BY heat_level",
)
oracle(
    "rule_category_levels",
    "cur",
    "SELECT category1_name, avg_popularity, CASE WHEN avg_popularity < 500000 THEN '小众' WHEN avg_popularity < 1000000 THEN '中等' "
    "WHEN avg_popularity < 5000000 THEN '热门' ELSE '超热门' END AS category_level "
    "FROM (SELECT category1_name, avg(numeric_popularity) AS avg_popularity FROM cur GROUP BY category1_name)",
    "avg_popularity",
)
oracle(
    "rule_quality_weighted",
    "ods",
    "SELECT book_id, rank_date, CAST((CASE WHEN p IS NULL THEN 0 ELSE 0.4 END) + (CASE WHEN r IS NULL THEN 0 ELSE 0.3 END) + "
    f"(CASE WHEN s IS NULL THEN 0 ELSE 0.3 END) AS DOUBLE) AS data_quality_score FROM (SELECT book_id, rank_date, {_PARSED} FROM ods)",
    "data_quality_score",
)
oracle(
    "fill_strategy_median",
    "num",
    "SELECT book_id, rank_date, " + ", ".join(f"coalesce({m}, m_{m}) AS {m}" for m in METRICS) + " FROM num, (SELECT "
    + ", ".join(f"quantile_cont({m}, 0.5) AS m_{m}" for m in METRICS) + " FROM num) middle",
    ALL,
)
oracle(
    "fill_strategy_mode",
    "num",
    "SELECT book_id, rank_date, "
    + ", ".join(
        f"coalesce({m}, (SELECT {m} FROM num WHERE {m} IS NOT NULL GROUP BY {m} ORDER BY count(*) DESC, {m} LIMIT 1)) AS {m}" for m in METRICS
    )
    + " FROM num",
    ALL,
)

# --- stored responses -------------------------------------------------------------------------------------------
_BROKEN = "o_orderkey % 13 = 0 OR o_orderkey % 17 = 0"
oracle(
    "x_ranklist_flatten",
    "",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS date_month, 'B' || (o_custkey + i) AS book_id, 'title \"' || o_orderpriority || '\"' AS title, "
    "CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'author ' || o_custkey END AS author, '' AS category1_name, '' AS category2_name, '' AS words_num, "
    "'' AS intro, '' AS image_link, coalesce(o_orderstatus, '') AS status, CAST(i AS VARCHAR) AS number, '万' AS unit "
    f"FROM orders, range(1, 4) t(i) WHERE i <= o_orderkey % 4 AND NOT ({_BROKEN})",
)
oracle(
    "x_ranklist_rejects",
    "",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS date_month, CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE 'rate limited' END AS reason "
    f"FROM orders WHERE {_BROKEN}",
)


def _detail(pattern: str, name: str) -> str:
    found = f"trim(regexp_extract(html, '{pattern}', 1))"
    return f"CASE WHEN html IS NULL THEN '请求失败' WHEN {found} <> '' THEN {found} ELSE '未找到' END AS {name}"


oracle(
    "x_detail_extract",
    "",
    "SELECT page_id, url, "
    + ", ".join(
        _detail(pattern, name)
        for name, pattern in (
            ("page_lang", '<html lang="([a-z]+)"'),
            ("page_title", "<title>([^<]*)</title>"),
            ("first_link", '<a href="/([^"]*)"'),
            ("score", '<em class="score">([^<]*)</em>'),
            ("read_count", '<em class="read_count">([^<]*)</em>'),
            ("popularity", '<em class="popularity">([^<]*)</em>'),
        )
    )
    + ", html IS NULL AS error, CASE WHEN html IS NULL THEN 'no response' ELSE '' END AS error_msg FROM "
    f"(SELECT * REPLACE ({PAGE_HTML.replace('as string', 'as varchar')} AS html) FROM pages)",
)
for _key in ("x_upsert_latest", "x_upsert_compacted"):
    oracle(
        _key,
        "crawled",
        "SELECT book_id, rank_name, date_month, gender, number, arrival, request FROM crawled WHERE gender <> '?' QUALIFY row_number() OVER "
        "(PARTITION BY gender, book_id, rank_name, date_month ORDER BY arrival DESC, request, number, response_size, page) = 1",
    )
oracle(
    "x_gender_unify",
    "crawled",
    "SELECT book_id, rank_name, date_month, number, CASE gender WHEN '男生' THEN 'male' ELSE 'female' END AS gender_type, "
    "CASE WHEN date_month = '' THEN NULL ELSE CAST(strptime(date_month || '01', '%Y%m%d') AS DATE) END AS rank_date FROM crawled WHERE gender <> '?'",
)
oracle(
    "x_coverage_gaps",
    "crawled",
    "SELECT gender, rank_name, date_month, CAST(page AS INTEGER) AS page FROM (SELECT g.gender, l.rank_name, l.date_month, p.page FROM "
    "(VALUES ('男生'), ('女生')) g(gender), (SELECT n.rank_name, strftime(m.d, '%Y%m') AS date_month FROM (VALUES ('大热'), ('新书'), ('完结')) "
    "n(rank_name), (SELECT unnest(generate_series(DATE '1994-01-01', DATE '1996-01-01', INTERVAL 1 MONTH)) AS d) m UNION ALL "
    "SELECT rank_name, '' FROM (VALUES ('收藏'), ('更新')) u(rank_name)) l, range(1, 6) p(page)) e WHERE NOT EXISTS (SELECT 1 FROM crawled c "
    "WHERE c.gender = e.gender AND c.rank_name = e.rank_name AND c.date_month = e.date_month AND c.page = e.page)",
)
oracle(
    "x_crawl_stats",
    "crawled",
    "SELECT count(*) FILTER (gender = '男生') AS male, count(*) FILTER (gender = '女生') AS female, count(*) FILTER (NOT error) AS success, "
    "count(*) FILTER (error) AS failed FROM crawled",
)

"""Values that results depend on. Every threshold is a default of some rule below and can be replaced by the caller."""

from __future__ import annotations

from dataclasses import dataclass

INF = float("inf")

# --- Fixed values: raw text formats -----------------------------------------------------------------------------
METRIC_UNITS = {"亿": 100000000.0, "万": 10000.0}
WORD_UNITS = {"万字": 10000.0, "字": 1.0}
URL_PATTERN = "^https?://"
DECIMAL_PATTERN = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
DATE_PATTERN = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
NEWLINE_PATTERN = "[\n\r]"
INVALID_TITLES = ("0", "1")
SERIALISING = "连载中"
FINISHED = "已完结"
STATUS_CODES = {"0": SERIALISING, "1": FINISHED}
UNKNOWN = "未知"
LABEL_DEFAULTS = {
    "category1_name": UNKNOWN,
    "category2_name": UNKNOWN,
    "status": UNKNOWN,
    "rank_name": UNKNOWN,
    "gender_type": "unknown",
}
NOT_FOUND = "未找到"
REQUEST_FAILED = "请求失败"
MALE_CHANNEL = "男生"
FEMALE_CHANNEL = "女生"
GENDER_OF_CHANNEL = {MALE_CHANNEL: "male", FEMALE_CHANNEL: "female"}

# --- Fixed values: keyword patterns -----------------------------------------------------------------------------
HOT_KEYWORDS = "系统|逆袭|重生|穿越|霸总|修仙|玄幻|都市|言情"
PAYMENT_LISTS = "打赏|月票|畅销|VIP"

# --- Fixed values: ladders, highest floor first, (floor, label); the last entry is the rest ----------------------
HEAT_LEVELS = ((10000000, "爆款"), (1000000, "热门"), (100000, "中等"), (None, "冷门"))
POPULARITY_STEPS = ((10000000, 5), (1000000, 4), (500000, 3), (100000, 2), (None, 1))
RECOMMENDATION_LEVELS = ((0.9, "强烈推荐"), (0.8, "推荐"), (0.7, "可看"), (None, "一般"))
IP_VALUE_LEVELS = ((10, "SSS级"), (5, "SS级"), (2, "S级"), (1, "A级"), (0.5, "B级"), (None, "C级"))
INVESTMENT_LEVELS = ((2, "S级"), (1, "A级"), (0.5, "B级"), (None, "C级"))
STICKINESS_LEVELS = ((100, "极强"), (50, "强"), (20, "中等"), (None, "弱"))

# --- Fixed values: ladders, lowest ceiling first, (ceiling, label); the last entry is the rest -------------------
WORDS_RANGES = (
    (200000, "短篇(<20万)"),
    (500000, "中篇(20-50万)"),
    (800000, "长篇(50-80万)"),
    (1500000, "超长篇(80-150万)"),
    (None, "巨著(>150万)"),
)
ATTENUATION_TYPES = ((20, "稳定型"), (50, "缓慢衰减"), (80, "快速衰减"), (None, "断崖式衰减"))

# --- Fixed values: labels picked by the first true flag ----------------------------------------------------------
INVESTED_IP_LEVELS = ("S级", "A级")  # of the report on investments
TOP_INVESTMENT_LEVEL = "S级"
RISK_LEVELS = ("高风险", "中风险", "低风险", "正常")
RISK_WEIGHTS = (0.3, 0.5, 0.7, 1.0)
RISK_ADVICE = ("强烈建议避开，疑似刷榜", "谨慎阅读，评分较低", "注意，热度与实际阅读不符", "可正常阅读")
IP_TYPES = ("短线爆款", "长线稳定", "波动型", "成长型")
ADAPTATIONS = ("适合短剧、网络电影", "适合影视剧、动漫、游戏", "适合短期营销炒作", "需持续观察")
INVESTMENT_ADVICE = ("强烈推荐-高付费+高质量", "推荐-高付费潜力", "可考虑-粉丝粘性强", "观望")
PURCHASING_RATINGS = ("优质资本标的", "高付费潜力", "中等付费潜力", "一般")

# --- Fixed values: declared level rules, (label, min, max) -------------------------------------------------------
AUTHOR_RULES = (("新人作家", 0, 1), ("新锐作家", 2, 4), ("资深作家", 5, 9), ("高产作家", 10, INF))
IP_RULES = (
    ("C级", 0, 5),
    ("B级", 5, 10),
    ("A级", 10, 20),
    ("S级", 20, 50),
    ("SS级", 50, 100),
    ("SSS级", 100, INF),
)
HEAT_RULES = (("冷门", 0, 100000), ("中等", 100000, 1000000), ("热门", 1000000, 10000000), ("爆款", 10000000, INF))
CATEGORY_RULES = (("小众", 0, 500000), ("中等", 500000, 1000000), ("热门", 1000000, 5000000), ("超热门", 5000000, INF))
QUALITY_WEIGHTS = {"numeric_popularity": 0.4, "numeric_read_count": 0.3, "numeric_score": 0.3}

# --- Fixed values: the crawl grid --------------------------------------------------------------------------------
MONTHLY_LISTS = ("大热", "新书", "完结")
UNDATED_LISTS = ("收藏", "更新")
CRAWL_FIRST_MONTH = "202310"
CRAWL_MONTHS = 25
CRAWL_PAGES = 5

# --- Fixed values: JDBC batching ---------------------------------------------------------------------------------
JDBC_FETCH_SIZE = 1000
JDBC_BATCH_SIZE = 1000


# --- Fixed values: thresholds and weights of the feature formulas ------------------------------------------------
@dataclass(frozen=True)
class HeatRules:
    new_book_days: int = 7
    min_new_book_days: int | None = None
    surge_growth_rate: float = 50


@dataclass(frozen=True)
class TrendRules:
    unworthy_popularity: float = 1000000
    unworthy_growth_rate: float = 5
    conversion_score: float = 8.0
    conversion_growth_rate: float = 20
    score_weight: float = 0.5
    conversion_weight: float = 0.5


@dataclass(frozen=True)
class ReasonRules:
    hot_keywords: str = HOT_KEYWORDS
    golden_words: tuple = (500000, 800000)
    heat_unit: float = 1000000


@dataclass(frozen=True)
class AttenuationRules:
    severe_rate: float = 80
    moderate_rate: float = 50
    target_percent: float = 20
    default_days: float = 90


@dataclass(frozen=True)
class RecommendationRules:
    hit_rank: int = 10
    hit_score: float = 8.5
    niche_rank: int = 5
    niche_score: float = 9.0
    niche_popularity: float = 5000000
    keep_rank: int = 20
    keep_score: float = 8.5
    score_weight: float = 0.7
    heat_weight: float = 0.3
    heat_scale: float = 5


@dataclass(frozen=True)
class PitfallRules:
    ratio_unit: float = 100000
    low_score_heat: float = 5000000
    low_score: float = 6.0
    boost_heat: float = 10000000
    boost_score: float = 5.5
    conversion_heat: float = 5000000
    conversion_percent: float = 10


@dataclass(frozen=True)
class LongTermRules:
    burst_volatility: float = 3
    burst_days: int = 30
    stable_volatility: float = 2
    stable_days: int = 90
    integral_unit: float = 10000000
    weights: tuple = (0.4, 0.3, 0.2, 0.1)


@dataclass(frozen=True)
class PurchasingRules:
    payment_lists: str = PAYMENT_LISTS
    missing_position: float = 999
    top_position: float = 50
    payment_boost: float = 1.5
    high_arpu: float = 50
    medium_arpu: float = 20
    good_score: float = 8.0
    loyal_quality: float = 50
    weights: tuple = (0.5, 0.3, 0.2)

"""Pipeline configuration.

Fixed values that must equal the reference's output labels and defaults are
kept together here, in natural order.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, replace

# --- fixed values (labels and defaults of the reference pipeline) -----------
PRICE_BANDS = ((20.0, "Baixo"), (40.0, "Médio"), (50.0, "Alto"))
PRICE_TOP_LABEL = "Premium"
STOCK_BANDS = ((5.0, "Baixo"), (15.0, "Médio"))
STOCK_TOP_LABEL = "Alto"
RATING_LABELS = ((1, "Muito Baixo"), (2, "Baixo"), (3, "Médio"), (4, "Alto"), (5, "Muito Alto"))
RATING_WORDS = (("One", 1), ("Two", 2), ("Three", 3), ("Four", 4), ("Five", 5))
DEFAULT_CATEGORY = "Outros"
PROBLEMATIC_CATEGORIES = ("Add a comment", "Default")
POPULARITY_RATING_WEIGHT = 0.7
POPULARITY_STOCK_WEIGHT = 0.3
RATING_SCALE = 5.0
RAW_COLUMNS = ("title", "price", "rating", "category", "image", "product_page",
               "availability", "stock", "image_base64")
PROCESSED_COLUMNS = ("id",) + RAW_COLUMNS
FEATURE_COLUMNS = ("price_range", "has_subtitle", "has_series", "starts_with_the",
                   "title_length", "rating_category", "stock_level", "title_word_count",
                   "has_numbers", "popularity_score")
BOOLEAN_FEATURES = ("has_subtitle", "has_series", "starts_with_the", "has_numbers")
SUBTITLE_MARK = ":"
SERIES_MARK = "("
TITLE_PREFIX = "The "
SLUG_MAX_LENGTH = 50
SLUG_EMPTY = "unknown"
KEYWORD_SCREEN_WORDS = ("comment", "default")
MEDIA_PATH_MARK = "/media/"
IMAGE_URL_EXTENSIONS = ("jpg", "jpeg", "png", "gif")
BASE64_MIN_LENGTH = 200
IQR_FACTOR = 1.5
TITLE_LENGTH_BINS = 20
TITLE_WORD_BINS = 15
# feature groups: columns whose name holds one of the words
FEATURE_GROUP_WORDS = {
    "price": ("price",),
    "title": ("title", "subtitle", "series", "the", "word", "length", "numbers"),
    "rating": ("rating",),
    "stock": ("stock",),
    "popularity": ("popularity",),
}
# feature groups: columns whose name starts with the prefix
FEATURE_GROUP_PREFIXES = {"category": "category_"}
# -----------------------------------------------------------------------------

#: More categories than this are encoded as one sparse map column.
ONE_HOT_FORMS = ("columns", "map")
ONE_HOT_COLUMNS = 500


@dataclass(frozen=True)
class Bands:
    """Ordered upper bounds (inclusive) with labels, and the label above."""

    bounds: tuple[tuple[float, str], ...]
    top_label: str | None

    def __post_init__(self):
        uppers = [b for b, _ in self.bounds]
        if uppers != sorted(uppers):
            raise ValueError(f"band bounds must be ascending: {uppers}")

    @staticmethod
    def price() -> "Bands":
        return Bands(PRICE_BANDS, PRICE_TOP_LABEL)

    @staticmethod
    def stock() -> "Bands":
        return Bands(STOCK_BANDS, STOCK_TOP_LABEL)

    def scaled(self, factor: float) -> "Bands":
        return Bands(tuple((b * factor, lab) for b, lab in self.bounds), self.top_label)


@dataclass(frozen=True)
class PipelineConfig:
    input_path: str | None = None
    processed_output: str | None = None
    features_output: str | None = None
    default_category: str = DEFAULT_CATEGORY
    problematic_categories: tuple[str, ...] = PROBLEMATIC_CATEGORIES
    price_bands: Bands = field(default_factory=Bands.price)
    stock_bands: Bands = field(default_factory=Bands.stock)
    # what the null gate does: "fail" raises, "report" only reports
    on_null: str = "fail"
    # what a line that does not fit the schema does: "fail" the run, or go to the
    # table at quarantine_path while the others go on
    bad_rows: str = "fail"
    quarantine_path: str | None = None
    id_prefix: str = "book_"
    id_hex_len: int = 32
    # one column per category, or one map column; more categories than one_hot_columns
    # are an error in the first form
    one_hot_form: str = "columns"
    one_hot_columns: int = ONE_HOT_COLUMNS
    one_hot_vocabulary: tuple[str, ...] | None = None

    def __post_init__(self):
        if self.on_null not in ("fail", "report"):
            raise ValueError("on_null must be 'fail' or 'report'")
        if self.bad_rows not in ("fail", "quarantine"):
            raise ValueError("bad_rows must be 'fail' or 'quarantine'")
        if self.bad_rows == "quarantine" and not self.quarantine_path:
            raise ValueError("bad_rows='quarantine' needs quarantine_path")
        if not 1 <= self.id_hex_len <= 32:
            raise ValueError("id_hex_len must be in 1..32")
        if self.one_hot_form not in ONE_HOT_FORMS:
            raise ValueError(f"one_hot_form must be one of {ONE_HOT_FORMS}")
        if self.one_hot_columns < 1:
            raise ValueError("one_hot_columns must be positive")

    @staticmethod
    def from_dict(d: dict) -> "PipelineConfig":
        known = {f.name for f in fields(PipelineConfig)}
        unknown = set(d) - known
        if unknown:
            raise ValueError(f"unknown config keys: {sorted(unknown)}")
        kw = dict(d)
        for k in ("price_bands", "stock_bands"):
            if k in kw and not isinstance(kw[k], Bands):
                v = kw[k]
                kw[k] = Bands(tuple((float(b), str(lab)) for b, lab in v["bounds"]), v.get("top_label"))
        for k in ("problematic_categories", "one_hot_vocabulary"):
            if k in kw and kw[k] is not None:
                kw[k] = tuple(kw[k])
        return PipelineConfig(**kw)

    @staticmethod
    def from_json(path: str) -> "PipelineConfig":
        with open(path, encoding="utf-8") as fh:
            return PipelineConfig.from_dict(json.load(fh))

    def with_paths(self, **kw) -> "PipelineConfig":
        return replace(self, **kw)

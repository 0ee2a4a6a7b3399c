"""The survey table: its columns, code lists, category labels and rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Codes and labels as they occur in the data, in their documented order.
AGE_GROUPS = ["u19", "20s", "30s", "40s", "50s", "60plus"]
GENDERS = ["male", "female", "other", "no_answer"]
OCCUPATIONS = ["company_employee", "student", "homemaker", "other"]
REGIONS = ["hokkaido_to_hoku", "kanto", "chubu", "kinki", "chugoku_shikoku", "kyushu_okinawa",
           "overseas", "no_answer"]
DRINKING_FREQS = ["daily", "weekly", "monthly", "never"]
NONALC_FREQS = ["first_time", "sometimes", "weekly"]
PURCHASE_INTENTS = ["def_buy", "maybe", "unsure", "no"]
PRICE_BANDS = ["under199", "200_249", "250_299", "300_349", "350plus"]
CATEGORIES = ["Appearance", "Aroma", "Flavor", "MouthfeelCarbonation", "DrinkabilityAftertaste",
              "ABV", "CaloriesCarbs", "AdditivesAllergen", "Ingredients", "PackagingDesign",
              "PackServingFormat", "ShelfLifeStorage", "PriceValue", "Availability",
              "PromotionVisibility", "BrandImageStory", "SocialAcceptability",
              "SustainabilityEthics"]
NO_ANSWER = "no_answer"

CATEGORY_NOTES = {
    "Appearance": "colour, clarity and foam to the eye",
    "Aroma": "smell, wanted or not",
    "Flavor": "sweet, bitter, sour, body, balance",
    "MouthfeelCarbonation": "gas strength and feel on the tongue",
    "DrinkabilityAftertaste": "ease of drinking and finish",
    "ABV": "mentions of alcohol strength",
    "CaloriesCarbs": "calories and sugar",
    "AdditivesAllergen": "additives, flavourings, allergens",
    "Ingredients": "raw materials and their origin",
    "PackagingDesign": "label and outer design",
    "PackServingFormat": "volume, container, pack count",
    "ShelfLifeStorage": "keeping and best-before",
    "PriceValue": "price and value for money",
    "Availability": "shops and online supply",
    "PromotionVisibility": "advertising and shelf promotion",
    "BrandImageStory": "brand image and story",
    "SocialAcceptability": "fine to drink when driving, pregnant and so on",
    "SustainabilityEthics": "environment and ethics",
}


def _closed(text: str, codes: list[str]) -> str:
    return f"{text}: {', '.join(codes)}"


def _open(text: str, codes: list[str]) -> str:
    return f"{text} (e.g. {', '.join(codes)})"


def _labelled(text: str) -> str:
    lines = [f"{i}. {c}: {CATEGORY_NOTES[c]}" for i, c in enumerate(CATEGORIES, 1)]
    return "\n".join([f"{text}, one of {len(CATEGORIES)}", *lines])


def _field(name: str, dtype: T.DataType, comment: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable, {"comment": comment})


_TEXTS = T.ArrayType(T.StringType())

SURVEY_COMMENT = "Survey responses with the columns that were derived from them for analysis"

# The table as the engine works with it: list columns are arrays and confidences are numbers.
SURVEY_SCHEMA = T.StructType([
    _field("id", T.LongType(), "Response key", nullable=False),
    _field("submitted_at", T.TimestampType(), "Submission time"),
    _field("age_group", T.StringType(), _open("Age band", AGE_GROUPS)),
    _field("gender", T.StringType(), _closed("Gender", GENDERS)),
    _field("occupation", T.StringType(), _open("Occupation", OCCUPATIONS)),
    _field("region", T.StringType(), _closed("Region", REGIONS)),
    _field("drives_weekly", T.BooleanType(), "Drives at least once a week"),
    _field("drinking_freq", T.StringType(), _closed("Drinking frequency", DRINKING_FREQS)),
    _field("fav_alcohols_arr", _TEXTS, "Favourite drinks (several answers)"),
    _field("nonalc_freq", T.StringType(), _closed("Non-alcoholic frequency", NONALC_FREQS)),
    _field("health_reasons_arr", _TEXTS, "Health reasons (several answers)"),
    _field("purchase_intent", T.StringType(), _closed("Purchase intent", PURCHASE_INTENTS)),
    _field("price_band", T.StringType(), _open("Accepted price", PRICE_BANDS)),
    _field("satisfaction_int", T.IntegerType(), "Satisfaction as a number, 1~5"),
    _field("free_comment", T.StringType(), "Free-text impression"),
    _field("positive_point", _TEXTS, "Positive phrases of the comment"),
    _field("negative_feedback", _TEXTS, "Negative phrases and wishes of the comment"),
    _field("scene", _TEXTS, "Drinking scenes in the comment"),
    _field("positive_point_category", T.StringType(), _labelled("Label of the positive phrases")),
    _field("positive_point_confidence", T.DoubleType(), "Confidence of the positive label, 0.0~1.0"),
    _field("negative_feedback_category", T.StringType(), _labelled("Label of the negative phrases")),
    _field("negative_feedback_confidence", T.DoubleType(), "Confidence of the negative label, 0.0~1.0"),
])

# Columns that stored tables hold as text although they mean a list or a number.
LISTS_AS_TEXT = ["positive_point", "negative_feedback", "scene"]
NUMBERS_AS_TEXT = ["positive_point_confidence", "negative_feedback_confidence"]


@dataclass(frozen=True)
class Rule:
    """What one column may hold: a code list (closed or open), a range, a text-held list, or a time or boolean."""

    column: str
    codes: tuple[str, ...] = ()
    closed: bool = True
    low: float | None = None
    high: float | None = None
    text_list: bool = False
    whole: bool = False
    typed: str | None = None


SURVEY_RULES = [
    Rule("age_group", tuple(AGE_GROUPS), closed=False),
    Rule("gender", tuple(GENDERS)),
    Rule("occupation", tuple(OCCUPATIONS), closed=False),
    Rule("region", tuple(REGIONS)),
    Rule("drinking_freq", tuple(DRINKING_FREQS)),
    Rule("nonalc_freq", tuple(NONALC_FREQS)),
    Rule("purchase_intent", tuple(PURCHASE_INTENTS)),
    Rule("price_band", tuple(PRICE_BANDS), closed=False),
    Rule("satisfaction_int", low=1, high=5, whole=True),
    Rule("submitted_at", typed="timestamp"),
    Rule("drives_weekly", typed="boolean"),
    Rule("positive_point_category", tuple(CATEGORIES)),
    Rule("positive_point_confidence", low=0.0, high=1.0),
    Rule("negative_feedback_category", tuple(CATEGORIES)),
    Rule("negative_feedback_confidence", low=0.0, high=1.0),
    *[Rule(c, text_list=True) for c in LISTS_AS_TEXT],
]

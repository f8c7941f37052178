"""Facts read from the free-text keyword column: side, marks, biopsy, medium, place,
species, photo type, age class and label. Rules are data; newest rule sets are defaults."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from resight.functions.match import first_match, flag, has

FEMALE, MALE, UNKNOWN = "FemaleJ", "MaleM", "UNK"

# --- Fixed values: keyword patterns and labels of the published cleaning rules -------------
SIDE_RULES = [("Left|left", "Left"), ("Right|right", "Right")]
RELIABLE_MARKS = "Indent|Notch"
SINGLE_MARKS = {"notch": "Notch", "indent": "Indent", "scar": "scar", "patch": "Patch"}
SPECIES_RULES = [("SW", "Sperm whale"), ("NBW", "Northern bottlenose")]
PLACE_RULES = [("Gully", "Gully"), ("Haldimand", "Haldimand"), ("Shortland", "Shortland")]
WEST_EDGE, EAST_EDGE, LATITUDE_EDGE = -58.7, -58.1, 44
DIGITAL_SINCE = 2015

# name -> (ordered rules, value when none matches)
LABEL_RULES: dict[str, tuple[list[tuple[str, str]], str | None]] = {
    "listing_2025": (
        [("Melon_F,|biopsy-Female", FEMALE), ("Melon_M,|biopsy-Male", MALE), ("Melon_UNK", UNKNOWN)],
        None,
    ),
    "morphology_2025": ([("Melon_F,", FEMALE), ("Melon_M,", MALE)], UNKNOWN),
    "summary_source": ([("Sum_F", FEMALE), ("Sum_M", MALE), ("Sum_UNK", UNKNOWN)], None),
    "melon_source": ([("Melon_F", FEMALE), ("Melon_M", MALE), ("Melon_UNK", UNKNOWN)], None),
    "catalogue_tags": (
        [
            (r"\bFemale-Juvenile\b", FEMALE),
            (r"\bSex_F\b", FEMALE),
            (r"\bFJ\b", FEMALE),
            (r"\bSex_M\b", MALE),
            (r"\bMM\b", MALE),
        ],
        UNKNOWN,
    ),
    "dorsal_tags": (
        [
            (r"\bFemaleJ\b", FEMALE),
            (r"\bbiopsy-Female\b", FEMALE),
            (r"\bMale\b", MALE),
            (r"\bbiopsy-Male\b", MALE),
        ],
        None,
    ),
    "biopsy_tags": ([(r"\bFemaleJ\b", FEMALE), (r"\bMale\b", MALE)], UNKNOWN),
    "short_codes": ([(r"\bSex_F\b", "FJ"), (r"\bSex_M\b", "MM")], UNKNOWN),
    "listing_2023": (
        [("FemaleJ,|F,", FEMALE), ("Male,|M,|MM,", MALE), ("FJ", FEMALE)],
        None,
    ),
    "listing_2020": ([("Female,", FEMALE), ("Male,|MM,", MALE), ("FJ", FEMALE)], None),
    "metadata": ([("Male", "Male"), ("FemaleJ", "Female-Juvenile")], None),
}
# flag column -> keyword
SEX_KEYWORDS = {
    "has_melon_f": "Melon_F",
    "has_melon_m": "Melon_M",
    "has_melon_unk": "Melon_UNK",
    "has_f2": "F2",
    "has_f3": "F3",
    "has_femalej": "FemaleJ",
    "has_m2": "M2",
    "has_m3": "M3",
    "has_malem": "MaleM",
    "has_sum_f": "Sum_F",
    "has_sum_m": "Sum_M",
    "has_sum_unk": "Sum_UNK",
}
# --- end of fixed values --------------------------------------------------------------------


def side(keyword: Column | str, ignore_case: bool = False) -> Column:
    """Left wins over Right; neither is UNK."""
    return first_match(keyword, SIDE_RULES, UNKNOWN, ignore_case)


def side_last_wins(keyword: Column | str) -> Column:
    """Lower-case side where Right overrides Left; null when neither (metadata variant)."""
    return first_match(keyword, [("Right", "right"), ("Left", "left")])


def reliable(keyword: Column | str) -> Column:
    return mark(keyword, RELIABLE_MARKS)


def mark(keyword: Column | str, pattern: str) -> Column:
    return F.when(has(keyword, pattern), "Yes").otherwise("No")


def biopsy(keyword: Column | str, ignore_case: bool = False) -> Column:
    """YES, or null: no biopsy seen is not a 'no'."""
    return F.when(has(keyword, "biopsy", ignore_case), "YES")


def medium(keyword: Column | str, year: Column | str, since: int = DIGITAL_SINCE) -> Column:
    year = F.col(year) if isinstance(year, str) else year
    return F.when(has(keyword, "Digital") | (year >= since), "Digital").otherwise("Film")


def medium_by_keyword(keyword: Column | str, year_tag: str = "2019") -> Column:
    """Older rule: a year tag in the keyword stands in for the year."""
    return F.when(has(keyword, f"Digital|{year_tag}"), "Digital").otherwise("Film")


def place(keyword: Column | str, longitude: Column | str) -> Column:
    """Longitude bins with a keyword override; first hit wins, unknown is '??'."""
    lon = F.col(longitude) if isinstance(longitude, str) else longitude
    return (
        F.when((lon <= WEST_EDGE) | has(keyword, "Gully"), "Gully")
        .when(lon < EAST_EDGE, "Shortland")
        .when(lon >= EAST_EDGE, "Haldimand")
        .otherwise("??")
    )


def place_by_keyword(keyword: Column | str, latitude: Column | str) -> Column:
    """Older rule: keyword first, then the latitude edge. A photo with neither gets null."""
    lat = F.col(latitude) if isinstance(latitude, str) else latitude
    by_latitude = F.when(lat >= LATITUDE_EDGE, "Shortland").when(lat < LATITUDE_EDGE, "Gully")
    return F.coalesce(first_match(keyword, PLACE_RULES), by_latitude)


def species(keyword: Column | str) -> Column:
    return first_match(keyword, SPECIES_RULES, UNKNOWN)


def photo_type(keyword: Column | str) -> Column:
    return F.when(has(keyword, "dorsal", ignore_case=True), "Dorsal").otherwise("Melon")


def label(keyword: Column | str, rule_set: str = "listing_2025") -> Column:
    rules, otherwise = LABEL_RULES[rule_set]
    return first_match(keyword, rules, otherwise)


def label_2021(
    keyword: Column | str, year: Column | str, biopsied: Column | str, biopsy_year: int = 2019
) -> Column:
    """Rule set of 2021: every animal biopsied in ``biopsy_year`` counts as 'Female'."""
    year = F.col(year) if isinstance(year, str) else year
    biopsied = F.col(biopsied) if isinstance(biopsied, str) else biopsied
    return F.when((year == biopsy_year) & (biopsied == "YES"), "Female").otherwise(
        label(keyword, "listing_2020")
    )


def genetic_label(label_col: Column | str, biopsied: Column | str) -> Column:
    """Label backed by a biopsy: Female, Male or null."""
    label_col = F.col(label_col) if isinstance(label_col, str) else label_col
    biopsied = F.col(biopsied) if isinstance(biopsied, str) else biopsied
    return F.when((label_col == FEMALE) & (biopsied == "YES"), "Female").when(
        (label_col == MALE) & (biopsied == "YES"), "Male"
    )


def keyword_flags(keyword: Column | str, words: Mapping[str, str] = SEX_KEYWORDS) -> list[Column]:
    return [flag(keyword, word).alias(name) for name, word in words.items()]


def any_flag(*names: str) -> Column:
    out = F.col(names[0])
    for name in names[1:]:
        out = out | F.col(name)
    return out


def indicators() -> list[Column]:
    """Current, historic and summary indicator from the flag columns."""
    current = (
        F.when(F.col("has_melon_f"), "Melon_F")
        .when(F.col("has_melon_m"), "Melon_M")
        .when(F.col("has_melon_unk"), "Melon_UNK")
        .otherwise("None")
    )
    historic = (
        F.when(any_flag("has_f2", "has_f3", "has_femalej"), "Female")
        .when(any_flag("has_m2", "has_m3", "has_malem"), "Male")
        .otherwise("None")
    )
    summary = (
        F.when(F.col("has_sum_f"), "Sum_F")
        .when(F.col("has_sum_m"), "Sum_M")
        .when(F.col("has_sum_unk"), "Sum_UNK")
        .otherwise("None")
    )
    return [
        current.alias("current_sex"),
        historic.alias("old_keyword_sex"),
        summary.alias("summary_sex"),
    ]


def age_class(keyword: Column | str) -> Column:
    """Calf before Juvenile before Adult ('not young')."""
    return first_match(keyword, [("samCalf", "Calf"), ("samJuv", "Juvenile")], "Adult")


def is_young(age: Column | str) -> Column:
    age = F.col(age) if isinstance(age, str) else age
    return age.isin("Calf", "Juvenile")


def minimum_age(first_class: Column, year: Column, first_year: Column) -> Column:
    """Years since the first record plus 0, 1 or 3 by the class in that first year."""
    offset = F.when(first_class == "Calf", 0).when(first_class == "Juvenile", 1).when(
        first_class == "Adult", 3
    )
    return year - first_year + offset


def short_code(label_col: Column | str) -> Column:
    """M, F or UNK; null counts as UNK."""
    label_col = F.col(label_col) if isinstance(label_col, str) else label_col
    return F.when(label_col == MALE, "M").when(label_col == FEMALE, "F").otherwise("UNK")


def known(label_col: Column | str, labels: Sequence[str] = (FEMALE, MALE)) -> Column:
    label_col = F.col(label_col) if isinstance(label_col, str) else label_col
    return F.coalesce(label_col.isin(*labels), F.lit(False))


def delimiter_to_semicolon(keyword: Column | str) -> Column:
    return F.translate(keyword, ",", ";")


def biopsy_text(keyword: Column | str) -> Column:
    """The annotation from the word 'biopsy' up to the next comma, semicolon or stop."""
    return F.regexp_substr(keyword, F.lit(r"\b[Bb]iopsy\b[^,;.]*"))

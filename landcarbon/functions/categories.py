"""Fixed values of the reports: land-cover categories, report classes and survey-point conditions."""

from __future__ import annotations

from decimal import Decimal
from typing import NamedTuple

# Category label of the baseline map -> short column name used in all tables.
CATEGORIES: dict[str, str] = {
    "Broadleaved - Broadleaved - Forest": "broadleaved",
    "Conifer - Conifer - Forest": "conifer",
    "Cropland - Arable - Cropland": "arable",
    "Eroding - Eroding - Eroded": "eroded",
    "Grassland - Extensive grassland - Extensive Grassland": "extensive_grassland",
    "Grassland - Extensive grassland - Modified Bog (LCA Uplands Correction)": "extensive_modified_bog",
    "Grassland - Intensive grassland - Intensive Grassland": "intensive_grassland",
    "Mapping offset - Mapping offset - Near Natural Bog": "mapping_offset",
    "Modified - Bracken-dominated - Modified Bog (LCA Uplands Correction)": "bracken",
    "Modified - Heather-dominated - Modified Bog": "heather",
    "Modified - Molinia-dominated - Modified Bog": "molinia",
    "Other - No cover data - Near Natural Bog": "no_cover_data",
    "Peat extraction - Domestic or unknown - Domestic Extraction": "domestic_extraction",
    "Peat extraction - Industrial - Industrial Extraction": "industrial_extraction",
    "Scrub - Scrub - Forest": "scrub",
    "Semi-natural - Near natural - Near Natural Bog": "near_natural",
    "Settlement - Settlement - Settlement": "settlement",
    "Woodland - Mixed or unknown - Forest": "mixed_woodland",
}
CATEGORY_COLUMNS: list[str] = list(CATEGORIES.values())

# Condition of a survey point -> percentage column of the wide report.
CONDITIONS: dict[str, str] = {
    "Actively eroding: Flat bare": "pct_eroding_flat_bare",
    "Actively eroding": "pct_eroding",
    "Actively eroding: Hagg/gully": "pct_eroding_hagg_gully",
    "Modified": "pct_modified",
    "Drained: Artificial": "pct_drained_artificial",
    "Forested / previously forested": "pct_forested",
    "Drained": "pct_drained",
    "Drained: Hagg/gully": "pct_drained_hagg_gully",
    "Near natural": "pct_near_natural",
    "Not provided": "pct_not_provided",
    "No peat": "pct_no_peat",
    "NA": "pct_na",
}
CONDITION_COLUMNS: list[str] = list(CONDITIONS.values())

# Which percentages make up each part of the area outside the map.
OUTSIDE_GROUPS: dict[str, list[str]] = {
    "eroding_outside_map": [
        "pct_eroding_flat_bare",
        "pct_eroding",
        "pct_eroding_hagg_gully",
        "pct_drained_hagg_gully",
    ],
    "modified_outside_map": [
        "pct_modified",
        "pct_drained_artificial",
        "pct_drained",
        "pct_near_natural",
        "pct_not_provided",
        "pct_no_peat",
        "pct_na",
    ],
    "forest_outside_map": ["pct_forested"],
}

# What happens to the remainder of a site that is not forestry.
REMAINDER_TO_MODIFIED = Decimal("0.85")
REMAINDER_TO_ERODING = Decimal("0.15")


class ReportClass(NamedTuple):
    label: str
    column: str
    members: dict[str, Decimal]


_WHOLE = Decimal("1")

# Report class -> weighted member columns. The forest part outside the map is in no class.
CLASSES: list[ReportClass] = [
    ReportClass(
        "Woodland",
        "woodland",
        {
            "broadleaved": _WHOLE,
            "conifer": _WHOLE,
            "scrub": _WHOLE,
            "mixed_woodland": _WHOLE,
            "unspecified_to_forest": _WHOLE,
        },
    ),
    ReportClass("Cropland", "cropland", {"arable": _WHOLE}),
    ReportClass(
        "Eroding",
        "eroding",
        {"eroded": Decimal("0.15"), "eroding_outside_map": _WHOLE, "unspecified_to_eroding": _WHOLE},
    ),
    ReportClass(
        "Drained Modified Bog",
        "drained_modified_bog",
        {
            "eroded": Decimal("0.85"),
            "bracken": _WHOLE,
            "mapping_offset": _WHOLE,
            "extensive_modified_bog": _WHOLE,
            "heather": _WHOLE,
            "molinia": _WHOLE,
            "no_cover_data": _WHOLE,
            "near_natural": _WHOLE,
            "settlement": _WHOLE,
            "modified_outside_map": _WHOLE,
            "unspecified_to_modified": _WHOLE,
        },
    ),
    ReportClass("Intensive Grassland", "intensive_grassland_class", {"intensive_grassland": _WHOLE}),
    ReportClass("Extensive Grassland", "extensive_grassland_class", {"extensive_grassland": _WHOLE}),
    ReportClass("Industrial Peat Extraction", "industrial_peat_extraction", {"industrial_extraction": _WHOLE}),
    ReportClass("Domestic Extraction", "domestic_peat_extraction", {"domestic_extraction": _WHOLE}),
]
CLASS_COLUMNS: list[str] = [c.column for c in CLASSES]
PROJECT_AREA = "project_area_class"

# Class column -> category name that the factor mapping uses.
HECTARE_LABELS: dict[str, str] = {c.column: f"{c.label} (ha)" for c in CLASSES}

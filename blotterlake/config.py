"""Constants and run parameters."""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values -------------------------------------------------------------------------
# Charge classes, least severe first; a class's position is its severity code.
SEVERITY_ORDER = ("None", "U", "Z", "P", "L", "C", "B", "A", "4", "3", "2", "1", "X", "M")
# Code for a missing or unknown class.
UNKNOWN_SEVERITY = -1
# Columns that identify a person or an address.
REDACT_COLUMNS = (
    "first_name", "last_name", "middle_name", "cb_no", "case_number",
    "street_no", "street_dir", "street_name",
)
# Combined charge columns that the per-slot columns replace.
DROP_COLUMNS = (
    "charges_statute", "charges_description", "charges_type", "charges_class", "charges_fbi_code",
)
# Manual rules: description prefix, micro category, macro category.
MANUAL_RULES = (("CTA - ", "Nuisance", "Other"),)
# Charge types that get a chart, in chart order.
CHARGE_TYPES = ("Felony", "Misdemeanor", "Petty or Other", "Not Specified")
# ---- end of fixed values ------------------------------------------------------------------


@dataclass(frozen=True)
class Settings:
    """Column names and thresholds of a run; pass a changed copy (``dataclasses.replace``)."""

    id_col: str = "arrest_id"  # assigned by ``prepare`` to a source that has none
    check_ids: bool = False  # fail on ids that are null or repeat; runs a job
    date_col: str = "arrest_date"
    district_col: str = "district"
    beat_col: str = "beat"
    unit_col: str = "unit"
    slots: int = 4
    redact: tuple[str, ...] = REDACT_COLUMNS
    drop: tuple[str, ...] = DROP_COLUMNS
    timestamp_columns: tuple[str, ...] = ("received_in_lockup", "released_from_lockup")
    profile_types: bool = False  # narrow the types of a source without a schema; runs a job
    rules: tuple[tuple[str, str, str], ...] = MANUAL_RULES
    max_edit_distance: int = 4
    edit_metric: str = "osa"
    stem: bool = True
    nb_alpha: float = 1.0
    split_seed: int = 0
    split_on: str = "row"  # or "description": keeps copies of a text on one side
    refit_full: bool = False  # refit on all known rows after evaluation
    lead_class_col: str = "charge_1_class"
    outlier_z: float | None = 3.0
    target_year: int | None = None
    n_hours: int | None = None  # None: as many angles as hours observed
    carry_hour: bool = False
    # Most stored bytes a lookup may have to be broadcast into the fact table; above it, shuffle joins.
    broadcast_bytes: int = 16 << 20

    def description(self, slot: int) -> str:
        return f"charge_{slot}_description"

    def micro(self, slot: int) -> str:
        return f"{self.description(slot)}_category_micro"

    def macro(self, slot: int) -> str:
        return f"{self.description(slot)}_category_macro"

    def police(self, slot: int) -> str:
        return f"{self.description(slot)}_police_related"

    @property
    def slot_numbers(self) -> range:
        return range(1, self.slots + 1)

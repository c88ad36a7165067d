"""Raw-table catalog: the 44 source tables, their merge keys and cursors.

Fixed values (must equal the source system's table layout): table name,
primary key column(s), incremental cursor column (None = full read + merge).
Composite keys are used where a single column would collapse distinct rows
(user_role, role_privilege); ``legacy_key`` keeps the single-column variant.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class TableSpec:
    name: str
    keys: tuple[str, ...]
    cursor: str | None = "date_created"
    legacy_key: tuple[str, ...] | None = None
    # Extra audit columns folded into the change cursor when present (H1).
    change_columns: tuple[str, ...] = field(default=("date_changed", "date_voided"))


# --- fixed values: table, key, cursor -------------------------------------
_RAW = [
    ("person", "person_id", "date_created"),
    ("person_name", "person_name_id", "date_created"),
    ("person_address", "person_address_id", "date_created"),
    ("person_attribute", "person_attribute_id", "date_created"),
    ("patient", "patient_id", "date_created"),
    ("patient_identifier", "patient_identifier_id", "date_created"),
    ("patient_identifier_type", "patient_identifier_type_id", "date_created"),
    ("encounter", "encounter_id", "encounter_datetime"),
    ("encounter_type", "encounter_type_id", "date_created"),
    ("encounter_provider", "encounter_provider_id", "date_created"),
    ("encounter_role", "encounter_role_id", "date_created"),
    ("obs", "obs_id", "obs_datetime"),
    ("visit", "visit_id", "date_created"),
    ("visit_type", "visit_type_id", "date_created"),
    ("location", "location_id", "date_created"),
    ("provider", "provider_id", "date_created"),
    ("concept", "concept_id", "date_created"),
    ("concept_name", "concept_name_id", "date_created"),
    ("concept_answer", "concept_answer_id", "date_created"),
    ("concept_class", "concept_class_id", "date_created"),
    ("concept_datatype", "concept_datatype_id", "date_created"),
    ("concept_set", "concept_set_id", "date_created"),
    ("program", "program_id", "date_created"),
    ("program_workflow", "program_workflow_id", "date_created"),
    ("program_workflow_state", "program_workflow_state_id", "date_created"),
    ("patient_program", "patient_program_id", "date_created"),
    ("patient_state", "patient_state_id", "date_created"),
    ("orders", "order_id", "date_created"),
    ("drug", "drug_id", "date_created"),
    ("drug_order", "order_id", None),
    ("relationship", "relationship_id", "date_created"),
    ("users", "user_id", "date_created"),
    ("user_role", ("user_id", "role"), None),
    ("role_privilege", ("role", "privilege"), None),
    ("form", "form_id", "date_created"),
    ("form_field", "form_field_id", "date_created"),
    ("form_resource", "form_resource_id", None),
    ("global_property", "property", None),
    ("patient_appointment", "patient_appointment_id", "date_created"),
    ("appointment_service", "appointment_service_id", "date_created"),
    ("appointment_service_type", "appointment_service_type_id", "date_created"),
    ("appointment_service_weekly_availability", "service_weekly_availability_id", "date_created"),
    ("appointment_speciality", "speciality_id", "date_created"),
    ("patient_appointment_provider", "patient_appointment_provider_id", "date_created"),
]
# Single-column keys the source loader used for the two composite tables (H2).
_LEGACY_KEYS = {"user_role": ("user_id",), "role_privilege": ("role",)}
# ---------------------------------------------------------------------------


def _spec(name, key, cursor):
    keys = tuple(key) if isinstance(key, tuple) else (key,)
    return TableSpec(name=name, keys=keys, cursor=cursor, legacy_key=_LEGACY_KEYS.get(name))


RAW_TABLES: dict[str, TableSpec] = {n: _spec(n, k, c) for n, k, c in _RAW}


def spec(name: str) -> TableSpec:
    return RAW_TABLES[name]


def cursor_tables() -> list[str]:
    return [n for n, s in RAW_TABLES.items() if s.cursor]


def full_merge_tables() -> list[str]:
    return [n for n, s in RAW_TABLES.items() if not s.cursor]

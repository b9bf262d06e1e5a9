"""Source hospitals as data.

A hospital is one spec: adding a third source is one more ``Hospital`` entry,
not another copy of the extract job.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from types import MappingProxyType


@dataclass(frozen=True)
class Hospital:
    name: str  # datasource value in silver/gold, and landing folder name
    key_prefix: str  # prefix of every surrogate key built from this source
    database: str  # data_source value in the audit log / load config
    claim_file_tag: str  # claims files of this hospital contain this tag in their path
    # entity -> {source column: conformed column}
    renames: Mapping[str, Mapping[str, str]] = field(default_factory=dict)

    def renames_for(self, entity: str) -> Mapping[str, str]:
        return self.renames.get(entity, {})


# --- fixed values: these must equal the reference pipeline's for equal results ---
# Surrogate-key prefixes:            "HOSP-A-", "HOSP-B-"
# Datasource names:                  "hospital-a", "hospital-b"
# Operational database names:        "hospital_a_db", "hospital_b_db"
# Claims file tag of hospital A:     "hospital1" (a path without it belongs to hospital B)
# Hospital B patient column names:   id, f_name, l_name, m_name
#                                    (= patientid, firstname, lastname, middlename)
# Provider key pattern:              "PROV.*"
# Default high-water mark:           "1900-01-01 00:00:00"
# Landing file date format:          ddMMyyyy
# Approved claim status:             "Approved"
# Landing-job event messages (as the pipeline logs them):
#   "No existing files for table {table}"
#   "Latest watermark for {table}: {watermark}"
#   "Successfully extracted data from {table}"
#   "Audit log updated for {table}"
#   "Error processing {table}: {error}"
#   "Successfully read the config file"
HOSPITAL_A = Hospital(
    name="hospital-a",
    key_prefix="HOSP-A-",
    database="hospital_a_db",
    claim_file_tag="hospital1",
)
HOSPITAL_B = Hospital(
    name="hospital-b",
    key_prefix="HOSP-B-",
    database="hospital_b_db",
    claim_file_tag="hospital2",
    renames=MappingProxyType(
        {
            "patients": MappingProxyType(
                {"id": "patientid", "f_name": "firstname", "l_name": "lastname", "m_name": "middlename"}
            )
        }
    ),
)
PROVIDER_KEY_PATTERN = "PROV.*"
DEFAULT_WATERMARK = "1900-01-01 00:00:00"
LANDING_DATE_FORMAT = "%d%m%Y"  # ddMMyyyy
APPROVED = "Approved"
MSG_NO_FILES = "No existing files for table {table}"
MSG_WATERMARK = "Latest watermark for {table}: {watermark}"
MSG_EXTRACTED = "Successfully extracted data from {table}"
MSG_AUDITED = "Audit log updated for {table}"
MSG_ERROR = "Error processing {table}: {error}"
MSG_CONFIG_READ = "Successfully read the config file"
# --- end of fixed values ---

HOSPITALS: tuple[Hospital, ...] = (HOSPITAL_A, HOSPITAL_B)

# The hospital a claims file belongs to when its path carries no known tag
# (the reference sends every such path, NULL included, to hospital B).
DEFAULT_CLAIMS_HOSPITAL = HOSPITAL_B

# The five operational tables every hospital lands.
ENTITIES = ("departments", "encounters", "patients", "providers", "transactions")

# The column that names a row in its source (conformed name).
SOURCE_KEYS = {
    "departments": "deptid",
    "encounters": "encounterid",
    "patients": "patientid",
    "providers": "providerid",
    "transactions": "transactionid",
}


def hospital_by_database(database: str) -> Hospital:
    for h in HOSPITALS:
        if h.database == database:
            return h
    raise KeyError(database)

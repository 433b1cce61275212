"""Column roles, category sets and eras shared by every operator."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The violent categories of the distribution profiles.
VIOLENT_10 = (
    "BATTERY",
    "ASSAULT",
    "ROBBERY",
    "HOMICIDE",
    "CRIM SEXUAL ASSAULT",
    "SEX OFFENSE",
    "WEAPONS VIOLATION",
    "CRIMINAL SEXUAL ASSAULT",
    "KIDNAPPING",
    "INTIMIDATION",
)

# The wider set of the forecast and of the fairness audit.
VIOLENT_14 = VIOLENT_10 + (
    "STALKING",
    "OFFENSE INVOLVING CHILDREN",
    "CRIMINAL DAMAGE",
    "NARCOTICS",
)


@dataclass(frozen=True)
class Roles:
    """Names of the columns that play each part in an incident table.

    ``year_part`` names a partition column holding the calendar year, if the
    table was written with one; year thresholds then prune whole directories.
    """

    id: str = "id"
    ts: str = "ts"
    block: str = "block"
    unit: str = "unit"
    district: str = "district"
    category: str = "category"
    violent: str = "violent"
    arrest: str = "arrest"
    domestic: str = "domestic"
    year_part: str | None = None


ROLES = Roles()

# Header names of the raw table, by role.
RAW_HEADERS = Roles(
    id="ID",
    ts="Date",
    block="Block",
    unit="Beat",
    district="District",
    category="Primary Type",
    violent="",
    arrest="Arrest",
    domestic="Domestic",
)

# Text format of the raw timestamp. One-letter fields read both
# padded and unpadded digits.
RAW_TS_FORMAT = "M/d/yyyy h:mm:ss a"


def text_schema(*names: str, corrupt: str | None = None) -> T.StructType:
    """All-string schema in file order, with an optional malformed-row column."""
    fields = [T.StructField(n, T.StringType()) for n in names]
    if corrupt:
        fields.append(T.StructField(corrupt, T.StringType()))
    return T.StructType(fields)


@dataclass(frozen=True)
class Era:
    """A labelled span of calendar years, both ends included.

    ``divisor`` overrides the number of years used for yearly means.
    """

    label: str
    first: int
    last: int
    divisor: int | None = None

    @property
    def years(self) -> int:
        return self.divisor or self.last - self.first + 1


# The two eras compared by the paired test.
MAYOR_ERAS = (Era("Daley", 2001, 2011), Era("Emanuel", 2012, 2018))

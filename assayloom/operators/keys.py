"""Names of the cleaned key columns and the columns this package adds.

Key columns start with a reserved prefix, so that they never meet a column of
the source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayloom import fixed_values as fixed
from assayloom.functions.text import strip, tidy
from assayloom.rules import LabColumns

RESULT = "_lab_result"
UNIT = "_lab_unit"
CODE = "_lab_code"
NAME = "_lab_name"
EXCLUDED_BY = "_lab_excluded_by"
KEYS = [RESULT, UNIT, CODE, NAME]

NEW_COLUMNS = fixed.SPLIT_COLUMNS + fixed.STANDARD_COLUMNS


def source(name: str):
    """Reference to a source column whatever characters its name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def protect_source(rows: DataFrame, columns: LabColumns) -> tuple[DataFrame, LabColumns]:
    """Make room for the new columns.

    A source column with the exact name of a new column is dropped, the new
    one wins.  One that differs only in case (``UNIT``) cannot stand next to it
    in a case-insensitive session and becomes ``unit_recorded``.
    """
    sensitive = rows.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    taken = set(NEW_COLUMNS)
    roles = {f: getattr(columns, f) for f in ("code", "result", "unit", "name", "link", "file", "position")}
    used = set(filter(None, roles.values()))
    renamed = {}
    for name in rows.columns:
        if name in taken:
            if name in used:
                renamed[name] = name + "_recorded"
        elif not sensitive and name.lower() in taken:
            renamed[name] = name.lower() + "_recorded"
    kept = [c for c in rows.columns if c not in taken or c in renamed]
    clash = set(renamed.values()) & set(kept)
    if clash:
        raise ValueError(f"cannot rename source columns, names in use: {sorted(clash)}")
    out = rows.select([source(c).alias(renamed.get(c, c)) for c in kept])
    new_roles = {f: renamed.get(c, c) for f, c in roles.items()}
    return out, LabColumns(**new_roles)


def with_keys(rows: DataFrame, columns: LabColumns) -> DataFrame:
    """Add the cleaned result, unit, code and test name."""
    name = strip(source(columns.name)) if columns.name else F.lit(None).cast("string")
    trimmed = rows.withColumns(
        {
            RESULT: strip(source(columns.result)),
            UNIT: strip(source(columns.unit)),
            CODE: source(columns.code).cast("string"),
            NAME: name,
        }
    )
    return trimmed.withColumns({RESULT: tidy(F.col(RESULT)), UNIT: F.nullif(F.col(UNIT), F.lit(""))})

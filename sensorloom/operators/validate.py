"""Row contract checks: readings on the way in, tables on the way out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import FLOAT_FIELDS, MISSING_FIELD, REQUIRED_FIELDS, TYPE_ERROR
from ..functions.once import once
from ..functions.parse import float_sql, parse_float


def _missing_sql() -> str:
    tests = ", ".join(
        f"if({c} is null or {c} = '', '{name}', null)" for name, c in REQUIRED_FIELDS.items()
    )
    return f"coalesce({tests})"


def missing_field() -> Column:
    """Wire name of the first required field that is null or blank, in declared order."""
    return F.expr(_missing_sql())


def _float_error_sql(name: str, text: str, number: str) -> str:
    message = f"concat('Invalid float field: {name}=', chr(39), coalesce({text}, 'None'), chr(39))"
    return f"if({number} is null, {message}, null)"


def float_error(name: str, text: str) -> Column:
    """Error text where a float field holds no number, else null."""
    return F.expr(_float_error_sql(name, text, float_sql(text)))


def _type_error_sql(parsed: bool) -> str:
    tests = [
        _float_error_sql(
            name, REQUIRED_FIELDS[name], _NUMBERS[name] if parsed else float_sql(REQUIRED_FIELDS[name])
        )
        for name in FLOAT_FIELDS
    ]
    return f"coalesce({', '.join(tests)})"


def type_error() -> Column:
    """Error text of the first float field that holds no number."""
    return F.expr(_type_error_sql(parsed=False))


_NUMBERS = {name: f"_{REQUIRED_FIELDS[name]}" for name in FLOAT_FIELDS}


def with_numbers(raw: DataFrame) -> DataFrame:
    """Add the parsed float fields beside their texts; every text is matched once."""
    return once(raw, **{_NUMBERS[n]: parse_float(REQUIRED_FIELDS[n]) for n in FLOAT_FIELDS})


def _is_valid() -> Column:
    """The verdict on parsed rows. A number field that is blank has no number either."""
    tests = [f"coalesce({REQUIRED_FIELDS[n]} <> '', false)" for n in REQUIRED_FIELDS if n not in FLOAT_FIELDS]
    tests += [f"{number} is not null" for number in _NUMBERS.values()]
    return F.expr(" and ".join(tests))


def with_verdict(raw: DataFrame) -> DataFrame:
    """Add ``error_type`` and ``error_reason``; both are null on a valid row.

    Missing fields are looked for first, over all fields, then number formats. Dates are not
    checked here: each consumer applies its own date rule.
    """
    return judged_readings(raw).drop(*_NUMBERS.values())


def judged_readings(raw: DataFrame) -> DataFrame:
    """Rows with their parsed numbers, ``error_type`` and ``error_reason``: what a caller keeps
    who needs valid and invalid rows, so that every text is matched once."""
    missing, wrong = _missing_sql(), _type_error_sql(parsed=True)
    return with_numbers(raw).selectExpr(
        "*",
        f"""case when {missing} is not null then '{MISSING_FIELD}'
            when {wrong} is not null then '{TYPE_ERROR}' end as error_type""",
        f"coalesce(concat('Missing required field: ', {missing}), {wrong}) as error_reason",
    )


def valid_of(judged: DataFrame) -> DataFrame:
    """The rows of ``valid_readings``."""
    typed = {REQUIRED_FIELDS[name]: F.col(number) for name, number in _NUMBERS.items()}
    valid = judged.where("error_type is null").withColumns({**typed, "retry": F.lit(0)})
    return valid.drop("error_type", "error_reason", *_NUMBERS.values())


def rejected_of(judged: DataFrame) -> DataFrame:
    """The rows of ``rejected_readings``."""
    rejected = judged.where("error_type is not null").withColumn("retry", F.lit(0))
    return rejected.drop(*_NUMBERS.values())


def counts_of(judged: DataFrame, file_column: str = "file_name") -> DataFrame:
    """The rows of ``file_counts``."""
    return judged.groupBy(file_column).agg(
        F.count_if(F.col("error_type").isNull()).alias("success_count"),
        F.count_if(F.col("error_type").isNotNull()).alias("error_count"),
    )


def valid_readings(raw: DataFrame) -> DataFrame:
    """Valid rows with typed floats and ``retry = 0``; other columns pass through."""
    typed = {REQUIRED_FIELDS[name]: F.col(number) for name, number in _NUMBERS.items()}
    valid = with_numbers(raw).where(_is_valid())
    return valid.withColumns({**typed, "retry": F.lit(0)}).drop(*_NUMBERS.values())


def rejected_readings(raw: DataFrame) -> DataFrame:
    """Invalid rows, still as text, with their error columns and ``retry = 0``."""
    return with_verdict(raw).where("error_type is not null").withColumn("retry", F.lit(0))


def file_counts(raw: DataFrame, file_column: str = "file_name") -> DataFrame:
    """Valid and invalid rows per file; combined on the map side before the shuffle."""
    return (
        with_numbers(raw)
        .select(file_column, _is_valid().alias("_ok"))
        .groupBy(file_column)
        .agg(
            F.count_if("_ok").alias("success_count"),
            F.count_if(~F.col("_ok")).alias("error_count"),
        )
    )


# A table contract maps a column to (may not be null, longest text).
ALERT_CONTRACT: dict[str, tuple[bool, int | None]] = {
    "location": (True, 100),
    "alert_type": (True, 50),
    "event_time": (True, None),
}
ERROR_CONTRACT: dict[str, tuple[bool, int | None]] = {
    "error_type": (True, 50),
    "error_message": (True, None),
    "raw_row": (True, None),
    "location": (False, 50),
    "file_name": (False, 255),
    "processing_status": (False, 20),
}


def violation(contract: dict[str, tuple[bool, int | None]]) -> Column:
    """The first broken rule of a table contract as text, null where the row fits."""
    tests = []
    for name, (required, longest) in contract.items():
        if required:
            tests.append(F.when(F.col(name).isNull(), F.lit(f"{name} is null")))
        if longest is not None:
            tests.append(
                F.when(F.char_length(F.col(name)) > longest, F.lit(f"{name} is longer than {longest}"))
            )
    return F.coalesce(*tests)


def check_contract(
    df: DataFrame, contract: dict[str, tuple[bool, int | None]]
) -> tuple[DataFrame, DataFrame]:
    """Split into rows that fit a table and rows to quarantine (with ``violation``)."""
    marked = df.withColumn("violation", violation(contract))
    fits = marked.where(F.col("violation").isNull()).drop("violation")
    return fits, marked.where(F.col("violation").isNotNull())

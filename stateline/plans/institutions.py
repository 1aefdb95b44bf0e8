"""Schools and colleges (PIP-2, PIP-6, PIP-11)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stateline.functions import lookup
from stateline.functions.codes import CODE_TO_NAME, NAME_TO_ID
from stateline.functions.exact import mean
from stateline.operators.aggregate import crosstab, known, ratio_of_means
from stateline.operators.clean import drop_incomplete, impute_sentinel
from stateline.operators.columns import rename
from stateline.operators.ids import dense_ids
from stateline.operators.sets import distinct_rows, rank_by, tagged_union, union_all
from stateline.sources.manifest import EDUCATION, STAGING_EDUCATION

# Labels of the three sources, and the name an unknown state code gets.
PUBLIC, PRIVATE, COLLEGE = "public", "private", "No data"
UNKNOWN_STATE = "Alaska"

COMMON = {"NAME": "institution_name", "CITY": "city", "STATE": "state", "COUNTY": "county",
          "COUNTRY": "country"}
SCHOOL_COLUMNS = COMMON | {"ENROLLMENT": "n_students", "FT_TEACHER": "n_employees"}
COLLEGE_COLUMNS = COMMON | {"TOT_ENROLL": "n_students", "TOT_EMPLOY": "n_employees"}


def school_rows(public: DataFrame, private: DataFrame, scale: int | None = None) -> DataFrame:
    """Both kinds of school as one frame: repaired counts, complete rows only.

    The means that replace the negative counts are over all schools, also those dropped after it
    for a missing cell.
    """
    both = tagged_union(
        {PUBLIC: public.select(*SCHOOL_COLUMNS), PRIVATE: private.select(*SCHOOL_COLUMNS)},
        "availability",
    )
    schools = rename(both, SCHOOL_COLUMNS)
    return drop_incomplete(impute_sentinel(schools, ["n_students", "n_employees"], scale))


def college_rows(colleges: DataFrame) -> DataFrame:
    rows = rename(colleges.select(*COLLEGE_COLUMNS), COLLEGE_COLUMNS)
    return rows.withColumns(
        {
            "n_students": F.col("n_students").cast("double"),
            "n_employees": F.col("n_employees").cast("double"),
            "availability": F.lit(COLLEGE),
        }
    )


def clean_institutions(
    public: DataFrame,
    private: DataFrame,
    colleges: DataFrame,
    names: Mapping[str, str] = CODE_TO_NAME,
    ids: Mapping[str, int] = NAME_TO_ID,
    unknown: str = UNKNOWN_STATE,
    employed_only: bool = False,
    scale: int | None = None,
) -> DataFrame:
    """Raw schools and colleges → rows of the staging table.

    Ids run over public schools, private schools and colleges, in the order of state, city and
    name inside each. Negative counts of colleges are left for the quality gate.
    """
    rows = union_all(school_rows(public, private, scale), college_rows(colleges))
    if employed_only:
        rows = rows.where(F.col("n_employees") > 0)
    name = lookup.with_default(F.col("state"), names, unknown)
    rows = rows.withColumn("name_state", name).select(
        "institution_name",
        "city",
        "name_state",
        "n_students",
        "n_employees",
        "availability",
        lookup.with_default(F.col("name_state"), ids, 0).cast("bigint").alias("id_state"),
        F.when(F.col("availability") == PUBLIC, 0)
        .when(F.col("availability") == PRIVATE, 1)
        .otherwise(2)
        .alias("_source"),
    )
    order = ["_source", "name_state", "city", "institution_name", "n_students", "n_employees"]
    return dense_ids(rows, order, "id_institution").select(*STAGING_EDUCATION.names)


def defaulted_states(df: DataFrame, names: Mapping[str, str] = CODE_TO_NAME) -> DataFrame:
    """How many rows of a raw frame have a state code that falls back to the default."""
    return df.agg(F.count_if(lookup.is_unmatched(F.col("STATE"), names)).alias("defaulted"))


def build_education(staged: DataFrame) -> DataFrame:
    return distinct_rows(staged, *EDUCATION.names)


def institutions_per_state(rows: DataFrame, key: str = "name_state", scale: int | None = None) -> DataFrame:
    """Number of institutions and mean staff and students, most institutions first."""
    grouped = rows.where(known([key])).groupBy(key).agg(
        F.count("institution_name").alias("n_institutions"),
        mean(F.col("n_employees"), scale).alias("mean_employees"),
        mean(F.col("n_students"), scale).alias("mean_students"),
    )
    return rank_by(grouped, "n_institutions", key)


def availability_per_state(
    rows: DataFrame, names: Mapping[str, str], key: str = "name_state"
) -> DataFrame:
    return crosstab(rows, key, "availability", names)


def students_per_employee(rows: DataFrame, scale: int | None = None) -> DataFrame:
    """Mean students, mean staff and their ratio by availability."""
    means = ratio_of_means(
        rows, ["availability"], ("n_students", "mean_students"), ("n_employees", "mean_employees"),
        "proportion", scale,
    )
    return rank_by(means, "mean_students", "availability")

"""The raw data sets and the tables made from them (SRC-6): names, places, schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def schema(**kinds: str) -> T.StructType:
    names = {"long": T.LongType(), "double": T.DoubleType(), "text": T.StringType(), "date": T.DateType()}
    return T.StructType([T.StructField(name, names[kind]) for name, kind in kinds.items()])


DAILY_CASES = schema(
    date="long", state="text", positive="double", hospitalizedCurrently="double",
    hospitalizedCumulative="double", death="double",
)
COUNTY_CASES = schema(
    date="text", county="text", state="text", fips="text", cases="double", deaths="double",
)
SCHOOLS = schema(
    NAME="text", CITY="text", STATE="text", COUNTY="text", COUNTRY="text", ENROLLMENT="double",
    FT_TEACHER="double",
)
COLLEGES = schema(
    NAME="text", CITY="text", STATE="text", COUNTY="text", COUNTRY="text", TOT_ENROLL="double",
    TOT_EMPLOY="double",
)
CITIES = schema(state="text", race="text", count="long")
POPULATION = schema(POP_2021="long", NAME="text")
STATE_TEMPERATURES = schema(
    dt="text", AverageTemperature="double", AverageTemperatureUncertainty="double", State="text",
    Country="text",
)
CITY_TEMPERATURES = schema(
    dt="text", AverageTemperature="double", AverageTemperatureUncertainty="double", City="text",
    Country="text", Latitude="text", Longitude="text",
)


@dataclass(frozen=True)
class RawFile:
    path: str
    kind: str
    schema: T.StructType


# Where the raw files lie under the root folder.
RAW = {
    "cities": RawFile("raw/demographic/us-cities-demographics.json", "enveloped_json", CITIES),
    "population": RawFile("raw/demographic/population.json", "json_matrix", POPULATION),
    "private_schools": RawFile("raw/education/private_schools.csv", "csv", SCHOOLS),
    "public_schools": RawFile("raw/education/public_schools.csv", "csv", SCHOOLS),
    "colleges": RawFile("raw/education/colleges_universities.csv", "csv", COLLEGES),
    "temperatures": RawFile("raw/temperatures/temperatures_by_state.csv", "csv", STATE_TEMPERATURES),
    "daily_cases": RawFile("raw/covid/us_states_covid19_daily.csv", "csv", DAILY_CASES),
    "county_cases": RawFile("raw/covid/us_counties_covid19_daily.csv", "csv", COUNTY_CASES),
}

# Names, order and types of the staging and model columns.
STAGING_DEMOGRAPHIC = schema(
    id_state="long", name_state="text", american_native="double", asian="double",
    african_american="double", hispanic="double", white="double", total_population="long",
)
STAGING_EDUCATION = schema(
    id_institution="long", institution_name="text", city="text", name_state="text",
    n_students="double", n_employees="double", availability="text", id_state="long",
)
STAGING_TEMPERATURE = schema(
    id_state="long", name_state="text", avg_temp="double", autumn="double", spring="double",
    summer="double", winter="double",
)
STAGING_COVID = schema(
    id_covid_data="long", day_date="date", name_state="text", positive="double",
    hospitalized_curr="double", hospitalized_acum="double", death="double", id_state="long",
)
STATE = schema(
    id_state="long", name_state="text", american_native="double", asian="double",
    african_american="double", hispanic="double", white="double", total_population="long",
    avg_temp="double", avg_autumn_temp="double", avg_spring_temp="double",
    avg_summer_temp="double", avg_winter_temp="double",
)
EDUCATION = schema(
    id_institution="long", institution_name="text", city="text", id_state="long",
    n_students="double", n_employees="double", availability="text",
)
COVID = schema(
    id_covid_data="long", day_date="date", id_state="long", positive="double",
    hospitalized_curr="double", hospitalized_acum="double", death="double",
)

TABLES = {
    "staging_demographic": STAGING_DEMOGRAPHIC,
    "staging_education": STAGING_EDUCATION,
    "staging_temperature": STAGING_TEMPERATURE,
    "staging_covid": STAGING_COVID,
    "state": STATE,
    "education": EDUCATION,
    "covid": COVID,
}

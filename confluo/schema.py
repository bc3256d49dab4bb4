"""The record and profile contracts. Arrays are never null; locations and links are whole structs with null leaves."""

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    MapType,
    StringType,
    StructField,
    StructType,
)

S = StringType()


def _struct(**fields) -> StructType:
    return StructType([StructField(k, v) for k, v in fields.items()])


STRINGS = ArrayType(S)
LOCATION = _struct(city=S, region=S, country=S)
LINKS = _struct(linkedin=S, github=S, portfolio=S, other=STRINGS)
SKILL = _struct(name=S, sources=STRINGS)
EXPERIENCE = _struct(company=S, title=S, start=S, end=S, summary=S)
EDUCATION = _struct(institution=S, degree=S, field=S, end_year=IntegerType())
PROJECT = _struct(title=S, description=S, tech_stack=STRINGS)

RECORD = _struct(
    source=S, method=S, procured_at=S, full_name=S, emails=STRINGS, phones=STRINGS, location=LOCATION, links=LINKS, headline=S,
    years_experience=DoubleType(), skills=ArrayType(SKILL), experience=ArrayType(EXPERIENCE), education=ArrayType(EDUCATION), projects=ArrayType(PROJECT),
)

RATED_SKILL = _struct(name=S, sources=STRINGS, confidence=DoubleType())
PROVENANCE = _struct(field=S, value=S, source=S, method=S)

PROFILE = _struct(
    candidate_id=S, full_name=S, emails=STRINGS, phones=STRINGS, location=LOCATION, links=LINKS, headline=S, years_experience=DoubleType(),
    skills=ArrayType(RATED_SKILL), experience=ArrayType(EXPERIENCE), education=ArrayType(EDUCATION), projects=ArrayType(PROJECT),
    total_source_points=IntegerType(), overall_confidence=DoubleType(), provenance=ArrayType(PROVENANCE),
)

#: A resume as extracted: what the text and link extraction yields for each file.
RAW_RESUME = _struct(
    source_file=S, lines=ArrayType(S), sections=MapType(S, ArrayType(S)), links=ArrayType(_struct(url=S, anchor=S)), raw_text=S, procured_at=S,
)

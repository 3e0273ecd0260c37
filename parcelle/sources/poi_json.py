"""Nested point-of-interest responses: JSON documents whose ``elements`` carry a ``tags`` map.

One response (a line of a JSON file) becomes one row, its elements an array of structs, their tags a
map.  Tags are looked up in the map, so a tag nobody listed needs no schema change.  Nothing is shuffled to
flatten a response: the explode runs in the task that read the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelle.operators.spatial import exclusive_category
from parcelle.schemas import EXCLUSIVE_OUTPUT_COLUMNS
from parcelle.sources.grid import POI_SCHEMA

ELEMENT = "struct<type:string,id:bigint,lat:double,lon:double,center:struct<lat:double,lon:double>,tags:map<string,string>>"
BAD_RECORD = "_bad_record"
#: Tags that the categories and the point table use.
POINT_TAGS = ["amenity", "shop", "leisure", "public_transport", "tourism", "name"]


def read_responses(spark: SparkSession, path: str, keys: str) -> DataFrame:
    """Key columns (``keys``: DDL), elements and the raw text of a line that is no JSON (else null), one row per line."""
    return spark.read.schema(f"{keys}, elements array<{ELEMENT}>, {BAD_RECORD} string").option("columnNameOfCorruptRecord", BAD_RECORD).json(path)


def elements_of(responses: DataFrame) -> DataFrame:
    """The key columns and ``element`` per element; a response without elements keeps one row with a null element."""
    keys = [c for c in responses.columns if c not in ("elements", BAD_RECORD)]
    return responses.filter(F.col(BAD_RECORD).isNull()).select(*keys, F.explode_outer("elements").alias("element"))


def tag(name: str, element: str = "element") -> Column:
    """A tag's value, null where it is missing or the element has no tags."""
    return F.col(element).getField("tags").getItem(name)


def normalize(elements: DataFrame, tags: list[str] = POINT_TAGS, sep: str = ".") -> DataFrame:
    """Elements as flat columns named by their path (``center.lat``, ``tags.amenity``)."""
    e = F.col("element")
    keys = [F.col(c) for c in elements.columns if c != "element"]
    plain = [e.getField(c).alias(c) for c in ("type", "id")] + [e.getField(c).alias(f"element{sep}{c}") for c in ("lat", "lon")]
    centre = [e.getField("center").getField(c).alias(f"center{sep}{c}") for c in ("lat", "lon")]
    return elements.filter(e.isNotNull()).select(*keys, *plain, *centre, *[tag(t).alias(f"tags{sep}{t}") for t in tags])


def poi_points(elements: DataFrame) -> DataFrame:
    """The point table of the radius joins; an area has the place of its centre."""
    e = F.col("element")
    place = lambda c: F.coalesce(e.getField(c), e.getField("center").getField(c)).alias(c)
    flat = elements.filter(e.isNotNull()).select(e.getField("id").alias("poi_id"), place("lon"), place("lat"), *[tag(t).alias(t) for t in POINT_TAGS])
    return flat.select(*POI_SCHEMA.fieldNames())


def exclusive_counts(elements: DataFrame, keys: list[str]) -> DataFrame:
    """Per key, the elements by first matching category; keys whose responses hold none get zeros.

    The counts are added up in the tasks first, so a key with a third of the elements moves as one row a task."""
    tagged = elements.select(*keys, F.col("element").isNotNull().alias("_is"), *[tag(t).alias(t) for t in ("amenity", "leisure", "tourism")])
    category = F.when(F.col("_is"), exclusive_category())
    return tagged.groupBy(*keys).agg(*[F.count_if(category == c).alias(c) for c in EXCLUSIVE_OUTPUT_COLUMNS])

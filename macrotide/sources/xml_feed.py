"""Wage observations in XML: attributes of every element whose tag says it is an observation, whatever its prefix and
nesting; or, read with Spark's XML source, of one named element, the country possibly on its ``Series``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrotide.functions.parsing import parse_number, parse_year
from macrotide.schemas import WAGE_FEED
from macrotide.sources.json_feed import read_documents

# What an attribute name must contain to fill the field, tried in this order.
ATTRIBUTE_MARKS = {"year": ("time",), "value": ("value",), "country_code": ("country", "ref_area")}


# An element is an observation if its tag holds the first in this case, or the second in any.
OBSERVATION = ("Obs", "observation")
# A tag's name and its attributes.
NAMED = r"""[\p{L}_][^\s/>="']*+"""
QUOTED = r"""(?:"[^"]*+"|'[^']*+')"""
ATTRIBUTES = rf"""(?:\s++[^\s=/>"']++\s*+=\s*+{QUOTED})*+"""
# An opening tag with its attributes; the same with an observation's inside as the only group; comments, character data and
# instructions, which hold no elements.
TAG = rf"""<({NAMED})({ATTRIBUTES})\s*+/?+>"""
OBSERVED = rf"""<(?:(?=[^\s/>="']*?(?:{OBSERVATION[0]}|(?i:{OBSERVATION[1]})))({NAMED}{ATTRIBUTES})|{NAMED}{ATTRIBUTES})\s*+/?+>"""
ATTRIBUTE = r"""([^\s=/>"']++)\s*+=\s*+("[^"]*+"|'[^']*+')"""
NO_ELEMENTS = r"(?s)<(?:!--.*?-->|!\[CDATA\[.*?\]\]>|\?.*?\?>)"
# The inside of an element, attribute by attribute: a group for each field, which keeps the last attribute that fills it.
FIELDS = r"""(?i)^[^\s=/>"']++(?:\s++(?:%s))*+$""" % "|".join(
    [rf"""[^\s=/>"']*?(?:{"|".join(marks)})[^\s=/>"']*+\s*+=\s*+({QUOTED})""" for marks in ATTRIBUTE_MARKS.values()]
    + [rf"""[^\s=/>"']++\s*+=\s*+{QUOTED}"""])
# Stands between quoted texts, none of which holds it, alone or with what follows: they hold no quote of their own kind.
BETWEEN = "\"\"''"
# The entities of XML; the ampersand comes last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))


def _field_of(attribute: str) -> str | None:
    name = attribute.lower()
    return next((f for f, marks in ATTRIBUTE_MARKS.items() if any(m in name for m in marks)), None)


def wage_observations(elements: DataFrame, dataset_code: str) -> DataFrame:
    """Wage feed from one row per observation with its attributes as columns."""
    values: dict[str, list[Column]] = {f: [] for f in ATTRIBUTE_MARKS}
    for column in elements.columns:
        target = _field_of(column)
        if target:
            values[target].append(F.col(f"`{column}`").cast("string"))
    if not any(values.values()):
        return elements.sparkSession.createDataFrame([], WAGE_FEED)
    text = {f: F.coalesce(*c) if c else F.lit(None).cast("string") for f, c in values.items()}
    return elements.select(
        text["country_code"].alias("country_code"),
        parse_year(text["year"]).alias("year"),
        F.lit(dataset_code).alias("indicator"),
        parse_number(text["value"]).alias("value"),
    ).filter(F.coalesce("country_code", F.col("year").cast("string"), F.col("value").cast("string")).isNotNull())


def _plain(quoted: Column) -> Column:
    """The text of an attribute without its quotes and entities."""
    value = F.substr(quoted, F.lit(2), F.length(quoted) - 2)
    for entity, sign in ENTITIES:
        value = F.replace(value, F.lit(entity), F.lit(sign))
    return value


def tags(text: Column) -> Column:
    """Array of (tag, attributes) of all elements of an XML text, in order; attributes as an array of (name, value).
    The text is read once, by patterns that never go back, so a long document takes time in proportion."""
    def attribute(found: Column) -> Column:
        return F.struct(F.regexp_extract(found, ATTRIBUTE, 1).alias("name"), _plain(F.regexp_extract(found, ATTRIBUTE, 2)).alias("value"))

    opened = F.regexp_extract_all(F.regexp_replace(text, NO_ELEMENTS, ""), F.lit(TAG), F.lit(0))
    return F.transform(opened, lambda e: F.struct(
        F.regexp_extract(e, TAG, 1).alias("tag"),
        F.transform(F.regexp_extract_all(F.regexp_extract(e, TAG, 2), F.lit(ATTRIBUTE), F.lit(0)), attribute).alias("attributes")))


def observations(text: Column) -> Column:
    """Array of the observation elements of an XML text, in order, each as the quoted texts of its fields, empty where it has none,
    with `BETWEEN` between them. Read as `tags` does; an element costs one pattern, whatever its number of attributes."""
    elements = F.array_remove(F.regexp_extract_all(F.regexp_replace(text, NO_ELEMENTS, ""), F.lit(OBSERVED), F.lit(1)), "")
    fields = BETWEEN.join(f"${k}" for k in range(1, len(ATTRIBUTE_MARKS) + 1))
    return F.transform(elements, lambda e: F.regexp_replace(e, FIELDS, fields))


def parse_observations(documents: DataFrame, dataset_code: str, text: str = "value") -> DataFrame:
    """Wage feed from XML documents held as one text each, of every observation element. An attribute
    fills the first field whose mark its name holds; of several for one field the last in the element counts."""
    def field(place: int) -> Column:
        quoted = F.substring_index(F.substring_index("e", BETWEEN, place), BETWEEN, -1)
        return F.when(quoted != "", _plain(quoted))

    # Not a filter on the fields: Spark would compute them for it and once more for the result.
    elements = documents.select(F.explode(observations(F.col(text))).alias("e")).filter(F.col("e") != BETWEEN * (len(ATTRIBUTE_MARKS) - 1))
    texts = elements.select(*(field(k).alias(target) for k, target in enumerate(ATTRIBUTE_MARKS, 1)))
    return texts.select(
        "country_code", parse_year(F.col("year")).alias("year"), F.lit(dataset_code).alias("indicator"),
        parse_number(F.col("value")).alias("value"))


def read_observations(spark: SparkSession, path: str, dataset_code: str) -> DataFrame:
    """Wage feed from XML files of bounded size, one document each; see ``parse_observations``."""
    return parse_observations(read_documents(spark, path), dataset_code)


def nested_observations(series: DataFrame, obs: str = "Obs") -> DataFrame:
    """One row per observation of each series, the series' attributes repeated."""
    kind = series.schema[obs].dataType
    items = F.col(f"`{obs}`")
    if not isinstance(kind, T.ArrayType):
        items = F.array(items)
    own = [F.col(f"`{c}`") for c in series.columns if c != obs]
    # Not explode: Spark would filter on the array first and parse every document twice.
    exploded = series.select(*own, F.explode_outer(items).alias("__obs"))
    exploded = exploded.filter(F.col("__obs").isNotNull())
    inner = [n for n in exploded.schema["__obs"].dataType.names if n not in series.columns]
    return exploded.select(
        *[F.col(f"`{c}`") for c in series.columns if c != obs],
        *[F.col(f"__obs.`{n}`").alias(n) for n in inner],
    )


def parse_wage_documents(
    documents: DataFrame, schema: str, dataset_code: str, text: str = "value", obs: str = "Obs",
) -> DataFrame:
    """Documents whose root is a series, parsed with the given schema."""
    series = documents.select(F.from_xml(F.col(text), schema).alias("s")).select("s.*")
    return wage_observations(nested_observations(series, obs), dataset_code)


def read_wage_xml(
    spark: SparkSession, path: str, dataset_code: str, row_tag: str = "Obs",
    nested: str | None = None, schema: T.StructType | None = None,
) -> DataFrame:
    """Wage feed from XML files. ``row_tag`` is the element read as a row, with its prefix if
    the file uses one; with ``nested`` it is the series and ``nested`` the observation in it."""
    reader = spark.read.format("xml").option("rowTag", row_tag)
    if schema is not None:
        reader = reader.schema(schema)
    elements = reader.load(path)
    if nested is not None and nested in elements.columns:
        elements = nested_observations(elements, nested)
    return wage_observations(elements, dataset_code)

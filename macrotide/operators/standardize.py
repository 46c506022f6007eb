"""Country-code and percent standardisation of whole frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from macrotide.functions.country import (
    CountryLookup, is_iso3_shaped, loose_text, loose_words, normalized_code,
)
from macrotide.functions.parsing import parse_number
from macrotide.functions.percent import normalize_percentage
from macrotide.session import stored


#: Exact spellings up to this number are broadcast; longer lists are joined.
MOST_BROADCAST = 100_000
GRAM = 3


def _pieces(text: Column, n: int) -> Column:
    """The pieces of a text of n letters, in order."""
    last = F.char_length(text) - (n - 1)
    found = F.transform(F.sequence(F.lit(1), last), lambda i: F.substr(text, i, F.lit(n)))
    return F.when(last >= 1, found).otherwise(F.array().cast("array<string>"))


def _index_pieces(text: Column) -> Column:
    """The distinct pieces of up to three letters."""
    return F.array_distinct(F.concat(*[_pieces(text, n) for n in range(1, GRAM + 1)]))


def loose_codes(texts: DataFrame, names: DataFrame) -> DataFrame:
    """(text, iso3) of the texts that match a name: the first name that contains the text or lies in it, else
    the first name that shares a word. ``texts`` (text) are distinct, ``names`` (at, name, iso3) in the order of ``at``.

    Names are found through an inverted index of their pieces of up to three letters: a text in a name has all its
    pieces there, so its rarest piece leads to the names worth a look, and a name in a text is looked up by its own
    rarest piece. Words are joined to the first name of each word.
    """
    pieces = names.select("at", "name", F.explode(_index_pieces(F.col("name"))).alias("piece"))
    times = pieces.groupBy("piece").agg(F.count("*").alias("times"))

    def rarest(frame: DataFrame, column: str) -> DataFrame:
        text = F.col(column)
        own = F.when(F.char_length(text) >= GRAM, _pieces(text, GRAM)).otherwise(F.array(text))
        told = frame.select("*", F.explode(F.array_distinct(own)).alias("piece")).join(times, "piece", "left")
        order = F.struct(F.coalesce("times", F.lit(0)).alias("times"), "piece")
        return told.groupBy(*frame.columns).agg(F.min(order)["piece"].alias("piece"))

    in_names = rarest(texts, "text").join(pieces, "piece").filter(F.contains("name", F.col("text"))).select("text", "at")
    own_pieces = texts.select("text", F.explode(_index_pieces(F.col("text"))).alias("piece"))
    lying_in = own_pieces.join(rarest(names.select("at", "name"), "name"), "piece").filter(F.contains("text", F.col("name"))).select("text", "at")
    first_of_word = names.select("at", F.explode(loose_words(F.col("name"))).alias("word")).groupBy("word").agg(F.min("at").alias("at"))
    sharing = texts.select("text", F.explode(loose_words(F.col("text"))).alias("word")).join(first_of_word, "word").select("text", "at")
    found = in_names.union(lying_in).select("text", F.lit(0).alias("way"), "at").union(sharing.select("text", F.lit(1), "at"))
    first = found.groupBy("text").agg(F.min(F.struct("way", "at"))["at"].alias("at"))
    return first.join(names.select("at", "iso3"), "at").select("text", "iso3")


def _coded(df: DataFrame, lookup: CountryLookup, column: str) -> DataFrame:
    """The rows with their alpha-3 code in ``__iso3``, null where there is none.

    Three-letter codes stay as they are, then exact spellings, then loose matches. Only distinct texts without
    an exact spelling are matched loosely, once each, however many rows have them; they are written to the shared
    folder, as several joins start from them, and so are their matches: their size is known when the rows are joined to them, and
    unless it is large no row moves.
    """
    code, exact = F.col("__code"), F.col("__exact")
    spellings = lookup.spellings(df.sparkSession).toDF("__code", "__exact")
    if len(lookup.exact) <= MOST_BROADCAST:
        spellings = F.broadcast(spellings)
    known = is_iso3_shaped(code) | exact.isNotNull()
    prepared = (
        df.withColumn("__code", normalized_code(F.col(column))).join(spellings, "__code", "left")
        .withColumn("__text", F.when(~known, loose_text(code)))
    )
    texts = stored(prepared.filter(F.col("__text").isNotNull()).select(F.col("__text").alias("text")).distinct())
    matched = stored(loose_codes(texts, lookup.ordered_names(df.sparkSession)).toDF("__text_key", "__loose"))
    # rows without such a text meet no match; under keys of their own they do not pile up as nulls do
    key = F.coalesce("__text", F.concat(F.lit("\u0001"), code))
    joined = prepared.join(matched, key == F.col("__text_key"), "left")
    iso3 = F.when(is_iso3_shaped(code), code).otherwise(F.coalesce(exact, "__loose"))
    return joined.select(*df.columns, iso3.alias("__iso3"))


def with_codes(df: DataFrame, lookup: CountryLookup, column: str = "country_code") -> DataFrame:
    """The frame with the alpha-3 code of ``column`` in ``iso3``, null where there is none; landed,
    it gives both parts of ``split_coded`` without matching again."""
    if column not in df.columns:
        return df
    return _coded(df, lookup, column).withColumnRenamed("__iso3", "iso3")


def split_coded(coded: DataFrame, column: str = "country_code") -> tuple[DataFrame, DataFrame]:
    """Rows with their code replaced, and the distinct codes without one."""
    if column not in coded.columns:
        return coded, coded.sparkSession.createDataFrame([], f"`{column}` string")
    kept = [c for c in coded.columns if c != "iso3"]
    mapped = coded.filter(F.col("iso3").isNotNull()).select(
        *[F.col("iso3").alias(column) if c == column else F.col(c) for c in kept])
    return mapped, coded.filter(F.col("iso3").isNull()).select(column).distinct()


def standardize_countries(
    df: DataFrame, lookup: CountryLookup, column: str = "country_code"
) -> tuple[DataFrame, DataFrame]:
    """Rows with their code replaced, and the distinct codes that could not be mapped.

    Rows without a mapping are dropped. A frame without the column comes back unchanged.
    """
    if column not in df.columns:
        return df, df.sparkSession.createDataFrame([], f"`{column}` string")
    coded = _coded(df, lookup, column)
    mapped = coded.filter(F.col("__iso3").isNotNull()).withColumn(column, F.col("__iso3")).select(*df.columns)
    return mapped, coded.filter(F.col("__iso3").isNull()).select(column).distinct()


def normalize_columns(
    df: DataFrame, columns: Sequence[str], current_format: str = "auto"
) -> DataFrame:
    """Apply the feed's percent rule to the columns that exist."""
    present = [c for c in columns if c in df.columns]
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    values = {c: parse_number(F.col(c)) if c in text else F.col(c) for c in present}
    return df.withColumns({
        c: normalize_percentage(value, current_format) for c, value in values.items()
    })

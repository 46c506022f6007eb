"""Country names and codes to ISO 3166 alpha-3.

The ISO list itself is not shipped: codes and names come from the JVM's locale data, and
``ISO_SHORT_NAMES`` lists only the countries whose ISO short name is written differently
there. A caller with another list passes it as rows.

Lists of any length work: names are matched through an index of their letters and words, see
``operators.standardize``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from macrotide.functions.parsing import strip, strip_punctuation

# Spellings and codes that take precedence over the ISO list.
CUSTOM_COUNTRY_CODES = {
    "UNITED STATES": "USA",
    "US": "USA",
    "UNITED STATES OF AMERICA": "USA",
    "UNITED KINGDOM": "GBR",
    "UK": "GBR",
    "GREAT BRITAIN": "GBR",
    "RUSSIA": "RUS",
    "RUSSIAN FEDERATION": "RUS",
    "SOUTH KOREA": "KOR",
    "KOREA, REPUBLIC OF": "KOR",
    "KOREA": "KOR",
    "NORTH KOREA": "PRK",
    "CHINA": "CHN",
    "PEOPLE'S REPUBLIC OF CHINA": "CHN",
    "IRAN": "IRN",
    "IRAN, ISLAMIC REPUBLIC OF": "IRN",
    "VENEZUELA": "VEN",
    "VENEZUELA, BOLIVARIAN REPUBLIC OF": "VEN",
    "SYRIA": "SYR",
    "SYRIAN ARAB REPUBLIC": "SYR",
    "TANZANIA": "TZA",
    "UNITED REPUBLIC OF TANZANIA": "TZA",
    "VIETNAM": "VNM",
    "VIET NAM": "VNM",
    "BOLIVIA": "BOL",
    "PLURINATIONAL STATE OF BOLIVIA": "BOL",
    "MOLDOVA": "MDA",
    "REPUBLIC OF MOLDOVA": "MDA",
    "MACEDONIA": "MKD",
    "NORTH MACEDONIA": "MKD",
    "FORMER YUGOSLAV REPUBLIC OF MACEDONIA": "MKD",
    "WLD": "WLD",
    "EUU": "EUU",
    "HIC": "HIC",
    "LIC": "LIC",
    "MIC": "MIC",
    "UMC": "UMC",
    "LMC": "LMC",
    "OECD": "OECD",
    "EA19": "EA19",
    "EU28": "EU28",
    "G7": "G7",
    "G20": "G20",
}

# ISO 3166-1 short name (and common name, where the standard gives one) of the
# countries that the JVM's English locale names differently.
ISO_SHORT_NAMES = {
    "ATG": ("Antigua and Barbuda", None),
    "BES": ("Bonaire, Sint Eustatius and Saba", None),
    "BIH": ("Bosnia and Herzegovina", None),
    "BLM": ("Saint Barthélemy", None),
    "BOL": ("Bolivia, Plurinational State of", "Bolivia"),
    "BRN": ("Brunei Darussalam", None),
    "CIV": ("Côte d'Ivoire", None),
    "COD": ("Congo, The Democratic Republic of the", None),
    "COG": ("Congo", None),
    "CPV": ("Cabo Verde", None),
    "FLK": ("Falkland Islands (Malvinas)", None),
    "FSM": ("Micronesia, Federated States of", None),
    "HKG": ("Hong Kong", None),
    "HMD": ("Heard Island and McDonald Islands", None),
    "IRN": ("Iran, Islamic Republic of", "Iran"),
    "KNA": ("Saint Kitts and Nevis", None),
    "KOR": ("Korea, Republic of", "South Korea"),
    "LAO": ("Lao People's Democratic Republic", "Laos"),
    "LCA": ("Saint Lucia", None),
    "MAC": ("Macao", None),
    "MAF": ("Saint Martin (French part)", None),
    "MDA": ("Moldova, Republic of", "Moldova"),
    "MMR": ("Myanmar", None),
    "PCN": ("Pitcairn", None),
    "PRK": ("Korea, Democratic People's Republic of", "North Korea"),
    "PSE": ("Palestine, State of", None),
    "RUS": ("Russian Federation", None),
    "SGS": ("South Georgia and the South Sandwich Islands", None),
    "SHN": ("Saint Helena, Ascension and Tristan da Cunha", None),
    "SJM": ("Svalbard and Jan Mayen", None),
    "SPM": ("Saint Pierre and Miquelon", None),
    "STP": ("Sao Tome and Principe", None),
    "SXM": ("Sint Maarten (Dutch part)", None),
    "SYR": ("Syrian Arab Republic", "Syria"),
    "TCA": ("Turks and Caicos Islands", None),
    "TTO": ("Trinidad and Tobago", None),
    "TUR": ("Türkiye", None),
    "TWN": ("Taiwan, Province of China", "Taiwan"),
    "TZA": ("Tanzania, United Republic of", "Tanzania"),
    "UMI": ("United States Minor Outlying Islands", None),
    "VAT": ("Holy See (Vatican City State)", None),
    "VCT": ("Saint Vincent and the Grenadines", None),
    "VEN": ("Venezuela, Bolivarian Republic of", "Venezuela"),
    "VGB": ("Virgin Islands, British", None),
    "VIR": ("Virgin Islands, U.S.", None),
    "VNM": ("Viet Nam", "Vietnam"),
    "WLF": ("Wallis and Futuna", None),
}


def is_iso3_shaped(code: Column) -> Column:
    return code.rlike(r"^\p{L}{3}$")


def normalized_code(code: Column) -> Column:
    """Upper case without outer white space; empty text is no code."""
    text = F.upper(strip(code.cast("string")))
    return F.when(text != "", text)


class CountryLookup:
    """Country list in its priority order.

    ``countries`` holds (alpha_2, alpha_3, name, common_name); alpha_2 and common_name may be
    None. The order matters: the first country that matches loosely wins.
    """

    def __init__(
        self,
        countries: Iterable[tuple[str | None, str, str, str | None]],
        custom: dict[str, str] = CUSTOM_COUNTRY_CODES,
    ):
        by_code: dict[str, str] = {}
        self.names: dict[str, str] = {}
        for alpha_2, alpha_3, name, common_name in countries:
            if alpha_2:
                by_code[alpha_2] = alpha_3
            for spelling in filter(None, (name, common_name)):
                self.names[spelling.upper()] = alpha_3
        self.exact = {**self.names, **by_code, **custom}

    @classmethod
    def iso(cls, spark: SparkSession) -> CountryLookup:
        """The ISO 3166-1 countries, by alpha-3 code."""
        locale = spark._jvm.java.util.Locale
        rows = []
        for alpha_2 in locale.getISOCountries():
            country = locale("", alpha_2)
            alpha_3 = country.getISO3Country()
            name, common_name = ISO_SHORT_NAMES.get(
                alpha_3, (country.getDisplayCountry(locale.ENGLISH), None)
            )
            rows.append((alpha_2, alpha_3, name, common_name))
        return cls(sorted(rows, key=lambda row: row[1]))

    def spellings(self, spark: SparkSession) -> DataFrame:
        """(spelling, iso3) of the exact spellings."""
        return _rows(spark, {"spelling": list(self.exact), "iso3": list(self.exact.values())}, "spelling string, iso3 string")

    def ordered_names(self, spark: SparkSession) -> DataFrame:
        """(at, name, iso3) of the names in their order."""
        return _rows(spark, {"at": list(range(len(self.names))), "name": list(self.names), "iso3": list(self.names.values())},
                     "at int, name string, iso3 string")


def _rows(spark: SparkSession, columns: dict[str, list], schema: str) -> DataFrame:
    """Rows as data of the plan, not as constants in it; their size is known when joins are planned."""
    import pyarrow as pa

    kinds = {"int": pa.int32(), "string": pa.string()}
    types = dict(field.split() for field in schema.split(", "))
    return spark.createDataFrame(pa.table({name: pa.array(values, kinds[types[name]]) for name, values in columns.items()}))


def loose_text(code: Column) -> Column:
    """Code without punctuation, null when nothing is left."""
    text = strip(strip_punctuation(code, unicode=True))
    return F.when(text != "", text)


def loose_words(text: Column) -> Column:
    return F.split(text, r"(?U)\s+")

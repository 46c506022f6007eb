import random

import pytest

from support import values
from macrotide.functions.country import CountryLookup
from macrotide.operators.standardize import loose_codes, normalize_columns, standardize_countries

EXPECTED = {
    "US": "USA", "USA": "USA", "United States": "USA", "United States of America": "USA",
    "UK": "GBR", "GBR": "GBR", "Great Britain": "GBR", "United Kingdom": "GBR", "GB": "GBR",
    "DEU": "DEU", "Germany": "DEU", " germany ": "DEU", "de": "DEU", "China": "CHN", "CHN": "CHN",
    "People's Republic of China": "CHN", "OECD": "OECD", "EA19": "EA19", "ZZZ": "ZZZ", "zzz": "ZZZ",
    "Russia": "RUS", "Viet Nam": "VNM", "Bolivia, Plurinational State of": "BOL",
    "Côte d'Ivoire": "CIV", "South Korea": "KOR", "G20": "G20",
    # Loose: lies in a name, contains a name, shares a word.
    "Netherland": "NLD", "Kingdom of Norway": "NOR", "Lao Peoples": "LAO",
}


@pytest.fixture(scope="module")
def iso(spark):
    return CountryLookup.iso(spark)


def test_iso_spellings(spark, iso):
    rows = [(text, i) for i, text in enumerate(EXPECTED)] + [("Deutschland", 90), ("--", 91), ("", 92), (None, 93)]
    mapped, unmapped = standardize_countries(spark.createDataFrame(rows, "country_code string, i int"), iso)
    got = {r.i: r.country_code for r in mapped.collect()}
    assert got == {i: code for i, code in enumerate(EXPECTED.values())}
    assert {r[0] for r in unmapped.collect()} == {"Deutschland", "--", "", None}


def test_first_match_in_order_wins(spark):
    lookup = CountryLookup([
        ("AA", "AAA", "ALPHA ONE", None), ("BB", "BBB", "ALPHA ONE TWO", "BETA LAND"), (None, "CCC", "GAMMA LAND", None),
    ], custom={"GAMMA": "BBB"})
    rows = ["alpha", "alpha one", "the alpha one two", "my land", "gamma", "gamm", "aa", "AB", "beta!", "land beta"]
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, country_code string")
    mapped, unmapped = standardize_countries(frame, lookup)
    assert values(mapped) == [
        (0, "AAA"), (1, "AAA"), (2, "AAA"), (3, "BBB"), (4, "BBB"), (5, "CCC"), (6, "AAA"), (8, "BBB"), (9, "BBB"),
    ]
    assert values(unmapped) == ["AB"]


def test_matches_row_by_row_rule(spark, iso):
    """Against the rule written out in plain Python."""
    import re

    def rule(code):
        code = code.strip().upper()
        if re.fullmatch(r"[^\W\d_]{3}", code):
            return code
        if code in iso.exact:
            return iso.exact[code]
        text = re.sub(r"[^\w\s]", "", code).strip()
        if not text:
            return None
        for name, iso3 in iso.names.items():
            if text in name or name in text:
                return iso3
        for name, iso3 in iso.names.items():
            if set(text.split()) & set(name.split()):
                return iso3
        return None

    names = list(iso.names)
    texts = [n.title() for n in names] + [n[2:9] for n in names] + [f"{n.split()[-1]} xq" for n in names]
    texts += [f"old {n.lower()}!" for n in names] + ["qqqq", "12", "republic", "of", "the x"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, country_code string")
    mapped, _ = standardize_countries(frame, iso)
    got = {r.i: r.country_code for r in mapped.collect()}
    assert got == {i: rule(t) for i, t in enumerate(texts) if rule(t)}


def test_long_lists_of_names(spark):
    """50,000 names: an index of pieces and words, and no names in the plan."""
    def name(k):
        return f"PLACE{k:05d} {'EAST' if k % 2 else 'WEST'} BAY{k % 977}"

    lookup = CountryLookup([(None, f"C{k}", name(k), None) for k in range(50_000)], custom={})
    texts = ["place00017", "lace0100", "xx place00123 east bay123 yy", "bay976!", "y", "east", "zzzz zz", name(40_001), "00"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(100 + k, "place00017") for k in range(500)], "i int, country_code string")
    mapped, unmapped = standardize_countries(frame, lookup)
    assert "PLACE0" not in mapped._jdf.queryExecution().optimizedPlan().toString()
    got = {r.i: r.country_code for r in mapped.collect()}
    assert {k: got.pop(100 + k) for k in range(500)} == dict.fromkeys(range(500), "C17")
    assert got == {0: "C17", 1: "C1000", 2: "C123", 3: "C976", 4: "C0", 5: "C1", 7: "C40001", 8: "C0"}
    assert values(unmapped) == ["zzzz zz"]


def test_names_match_like_the_plain_rule(spark):
    """Random short names, so that pieces of one and two letters and shared words matter."""
    rng = random.Random(7)
    names = list(dict.fromkeys(" ".join("".join(rng.choice("ABC") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 2))) for _ in range(60)))
    texts = list(dict.fromkeys(" ".join("".join(rng.choice("ABCD") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 3))) for _ in range(400)))
    frame = spark.createDataFrame([(k, n, f"I{k}") for k, n in enumerate(names)], "at int, name string, iso3 string")
    got = {r.text: r.iso3 for r in loose_codes(spark.createDataFrame([(t,) for t in texts], "text string"), frame).collect()}
    want = {}
    for text in texts:
        first = next((k for k, n in enumerate(names) if text in n or n in text), None)
        if first is None:
            first = next((k for k, n in enumerate(names) if set(text.split()) & set(n.split())), None)
        if first is not None:
            want[text] = f"I{first}"
    assert got == want


def test_missing_column_changes_nothing(spark, iso):
    frame = spark.createDataFrame([(1,)], "x int")
    mapped, unmapped = standardize_countries(frame, iso)
    assert mapped is frame and unmapped.count() == 0


def test_normalize_columns(spark):
    frame = spark.createDataFrame([(12.0, "25.5", 1), (5.0, "n/a", 2)], "a double, b string, c int")
    assert values(normalize_columns(frame, ["a", "b", "absent"])) == [(0.12, 0.255, 1), (5.0, None, 2)]

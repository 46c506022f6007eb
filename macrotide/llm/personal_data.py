"""Personal data in text by weak supervision, in DataFrame functions only.

Base spans. Mail addresses, IP addresses, payment cards and international phone numbers follow four
patterns with their checks (parts up to 255, Luhn, number of digits). They are always kept.

Candidates. A looser pattern finds what the base misses: mail addresses written with (at) or (dot), numbers in the
shape of cards and phones inside longer runs of digits, account numbers, identity numbers, names
after a title. Four labelers vote for (1), against (-1) or abstain (0): the shape of the span (check
digits, grouping), a gazetteer (issuers, calling codes, countries, endings of mail hosts, given names), the words
around it, and whether base spans stand in the same text.

Aggregation. Expectation-maximisation over the counts of vote patterns estimates how often each labeler votes
each way on personal data and on other spans; base spans are known to be personal. Its posteriors
are the soft labels of a naive Bayes classifier over votes and features of the span (kind, digits, grouping,
length, the word before it). A candidate is added if a labeler speaks for it and the classifier gives it
`THRESHOLD` or more.

Positions. Spark finds matches but not where they are, so matches are fenced with a private
character (U+E000, which is swapped for another one where the text has it), the text is split there, and
positions are running sums of the lengths. The patterns start only where a match can start and give nothing back, so their
time grows in proportion to the text. They find what the stated base patterns find.

Scale. One pass over the texts leaves arrays of spans; the training reads only these. The driver gets the counts of
vote patterns (3 to the power of 4, twice) and of feature values (`BUCKETS` each), whatever the input. Nothing is shuffled but
those counts. Running sums are taken in blocks, so a text with very many matches stays near linear.

Cases. Null and empty texts have no spans. Repeated rows count as often as they occur. Without any spans no
model is trained and nothing is added. Empty tables give empty results. Other columns are ignored by the query and
kept by `redact`.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from macrotide.llm.common import staged, table, text_or_empty

KINDS = ("email", "ip", "card", "phone", "email_like", "card_like", "phone_like", "account", "identity", "person")
#: What a span is about, by its kind.
FAMILIES = ("email", "ip", "card", "phone", "email", "card", "phone", "account", "identity", "person")
BASE = 4
FENCE, INSTEAD = "\ue000", "\ue001"
THRESHOLD, BUCKETS, BLOCK, ROUNDS = 0.5, 64, 64, 100

# Base patterns. Each begins where a run of its characters begins (or where the last match ended) and is
# possessive; a run that ends otherwise has no match from any of its places.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Candidates.
MAIL_LIKE = (
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}+(?:"
    r"\x20?[(\[{]\x20?(?:at|At|AT|@)\x20?[)\]}]\x20?[A-Za-z0-9-]{1,63}+(?:(?:\.|\x20?[(\[{]\x20?(?:dot|Dot|DOT|\.)\x20?[)\]}]\x20?)[A-Za-z0-9-]{1,63}+){1,4}+"
    r"|\x20(?:at|AT)\x20[A-Za-z0-9-]{1,63}+(?:\x20(?:dot|DOT)\x20[A-Za-z0-9-]{1,63}+){1,4}+)")
NANP = r"(?:\+?1[\x20.-]?)?(?:\([2-9][0-9]{2}\)\x20?|[2-9][0-9]{2}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}"
CARD_LIKE = r"(?:[0-9]{4}(?:[\x20-]?[0-9]{4}){3}|[0-9]{12,19})"
IDENTITY = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
NUMBER = r"(?:(?:\+|00)[1-9][0-9]{0,2}|\(?0[0-9]{1,4}\)?)(?:[\x20./-]?[0-9]{2,4}+){2,5}+"
ACCOUNT = r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?"
#: Fixed list: titles before a name.
TITLES = ("Mr", "Mrs", "Ms", "Miss", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Mme", "Señor", "Señora", "Sr", "Sra")
PERSON = rf"(?:{'|'.join(TITLES)})\.?\x20\p{{Lu}}\p{{Ll}}{{1,30}}+(?:\x20\p{{Lu}}\p{{Ll}}{{1,30}}+)?"
LOOSE = (
    rf"{MAIL_LIKE}|(?<![0-9A-Za-z])(?:{NANP}|{CARD_LIKE}|{IDENTITY}|{NUMBER})(?![0-9A-Za-z])"
    rf"|(?<![A-Za-z0-9]){ACCOUNT}(?![A-Za-z0-9])|(?<!\p{{L}}){PERSON}(?!\p{{L}})")

# Gazetteers and context words: fixed lists.
MAIL_ENDINGS = ("com", "org", "net", "edu", "gov", "info", "io", "eu", "de", "fr", "es", "it", "nl", "uk", "ch", "at", "be", "us", "ca", "mx")
ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
CALLING = r"^(?:\+|00)(?:1|3[0-469]|4[0-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"
TOLL_FREE = r"^\+?1?[^0-9]{0,2}(?:800|833|844|855|866|877|888)"
ACCOUNT_COUNTRIES = ("AT", "BE", "CH", "CZ", "DE", "DK", "ES", "FI", "FR", "GB", "GR", "HU", "IE", "IT", "LI", "LU", "NL", "NO", "PL", "PT", "RO", "SE")
GIVEN_NAMES = (
    "Anna", "Anne", "Antonio", "Barbara", "Carlos", "Carmen", "Charles", "Christian", "Daniel", "David", "Elizabeth", "Emma", "Eva", "François",
    "Hans", "Isabel", "James", "Jean", "Jennifer", "John", "Jose", "José", "Juan", "Karl", "Laura", "Linda", "Louis", "Luis", "Manuel", "Maria", "María",
    "Marie", "Mary", "Michael", "Michel", "Miguel", "Nicolas", "Patricia", "Paul", "Pedro", "Peter", "Pierre", "Robert", "Sophie", "Susan",
    "Thomas", "Ursula", "William", "Wolfgang")
FOR = (
    "phone|tel|call|mobile|cell|fax|contact|mail|write|reach|card|visa|credit|account|iban|bank|ssn|social security|passport|name|born|address|"
    "téléphone|appel|portable|courriel|carte|compte|nom|adresse|telefon|handy|ruf|konto|karte|anschrift|teléfono|móvil|correo|tarjeta|cuenta|nombre|dirección")
AGAINST = r"version|page|isbn|issn|issue|figure|chapter|order|invoice|error|line|serial|year|price|total|model|article|seite|jahr|année|prix|año|precio|[$€£#]\s*$"


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, also where f uses it inside a lambda."""
    return F.transform(F.array(value), f)[0]


def running(lengths: Column) -> Column:
    """The sums of what comes before each element, taken in blocks."""
    def add(a, x):
        return a + x

    def block(c):
        return F.slice(lengths, c * BLOCK + 1, F.lit(BLOCK))

    blocks = F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / BLOCK).cast("int"))
    sums = F.transform(blocks, lambda c: F.aggregate(block(c), F.lit(0), add))
    return let(sums, lambda sums: F.flatten(F.transform(blocks, lambda c: let(
        F.aggregate(F.slice(sums, F.lit(1), c), F.lit(0), add), lambda before: let(block(c), lambda own: F.transform(
            own, lambda _, i: before + F.aggregate(F.slice(own, F.lit(1), i), F.lit(0), add)))))))


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, kind, end, value, before, after) of the matches in order; before and after are up to 40 and 20
    characters around a match, not reaching into another one."""
    fenced = F.regexp_replace(text, f"(?:{pattern})", f"{FENCE}$0{FENCE}")

    def spans(parts: Column) -> Column:
        lengths = F.transform(parts, F.char_length)
        return let(lengths, lambda lengths: let(running(lengths), lambda starts: F.transform(
            F.sequence(F.lit(1), F.size(parts) - 2, F.lit(2)), lambda i: F.struct(
                starts[i].alias("start"), F.lit(0).alias("kind"), (starts[i] + lengths[i]).alias("end"), parts[i].alias("value"),
                F.right(parts[i - 1], F.lit(40)).alias("before"), F.left(parts[i + 1], F.lit(20)).alias("after")))))

    return let(F.split(fenced, FENCE), lambda parts: F.when(F.size(parts) > 1, spans(parts)).otherwise(no_spans()))


def no_spans() -> Column:
    return F.array().cast("array<struct<start:int,kind:int,end:int,value:string,before:string,after:string>>")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def of_kind(spans: Column, kind: Column | Callable[[Column], Column]) -> Column:
    return F.transform(spans, lambda s: s.withField("kind", kind(s) if callable(kind) else kind))


def listed(names: tuple[str, ...]) -> str:
    return "|".join(names)


def loose_kind(span: Column) -> Column:
    value = span["value"]
    number = F.length(digits(value))
    kind = (
        F.when(value.rlike(r"@|\bat\b|\bAt\b|\bAT\b"), F.lit("email_like")).when(value.rlike("^[A-Z]{2}[0-9]{2}"), F.lit("account"))
        .when(value.rlike(r"^\p{L}"), F.lit("person")).when(value.rlike(f"^{IDENTITY}$"), F.lit("identity"))
        .when((number >= 12) & ~value.rlike(r"[+().]"), F.lit("card_like")).otherwise(F.lit("phone_like")))
    return F.array_position(F.array(*map(F.lit, KINDS)), kind).cast("int") - 1


def outside(loose: Column, base: Column) -> Column:
    """The loose spans that no base span holds whole: base spans that begin earlier (or at the same place) come first,
    and a span that ends behind all of them is outside."""
    def marked(spans, flag):
        return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), F.lit(flag).alias("loose"), s.alias("span")))

    def step(state, x):
        base_span = F.struct(F.greatest(state["reach"], -x["back"]).alias("reach"), state["kept"].alias("kept"))
        kept = F.struct(state["reach"].alias("reach"), F.concat(state["kept"], F.array(x["span"])).alias("kept"))
        return F.when(x["loose"] == 0, base_span).when(-x["back"] <= state["reach"], state).otherwise(kept)

    start = F.struct(F.lit(0).alias("reach"), F.slice(loose, F.lit(1), F.lit(0)).alias("kept"))
    found = F.aggregate(F.sort_array(F.concat(marked(base, 0), marked(loose, 1))), start, step, lambda s: s["kept"])
    return F.when(F.size(loose) > 0, found).otherwise(loose)


def with_spans(documents: DataFrame) -> DataFrame:
    """The documents with arrays `__base` and `__loose` of spans; loose ones lie in no base span."""
    text = text_or_empty()
    text = F.when(text.contains(FENCE), F.translate(text, FENCE, INSTEAD)).otherwise(text)

    def found(k: int, pattern: str, sign: str, holds: Callable[[Column], Column] | None = None) -> Column:
        spans = of_kind(matches(F.col("__text"), pattern), F.lit(k))
        spans = F.filter(spans, lambda s: holds(s["value"])) if holds else spans
        return F.when(F.col("__text").rlike(sign), spans).otherwise(no_spans())

    base = [
        found(0, EMAIL, "@"),
        found(1, IP, r"[0-9]\.[0-9]", lambda v: v.rlike(rf"^{PART}(?:\.{PART}){{3}}$")),
        found(2, CARD, "[0-9][\\x20-]?[0-9]", lambda v: F.call_function("luhn_check", digits(v))),
        found(3, PHONE, r"\+[0-9]", lambda v: F.length(digits(v)).between(9, 15)),
    ]
    sign = rf"[0-9][^0-9]?[0-9]|[(\[{{]\x20?(?:at|At|AT|@)|\x20(?:dot|DOT)\x20|(?:{listed(TITLES)})\.?\x20"
    loose = F.when(F.col("__text").rlike(sign), of_kind(matches(F.col("__text"), LOOSE), loose_kind)).otherwise(no_spans())
    out = documents.withColumn("__text", text).withColumn("__base", F.concat(*base)).withColumn("__loose", loose)
    return out.withColumn("__loose", outside(F.col("__loose"), F.col("__base"))).drop("__text")


def check97(value: Column) -> Column:
    """The check of account numbers: letters count as 10 to 35, the first four characters go last."""
    plain = F.regexp_replace(value, "\\x20", "")
    turned = F.concat(F.substr(plain, F.lit(5)), F.left(plain, F.lit(4)))
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda a, c: F.when(c == "", a).when(
        c.rlike("[0-9]"), (a * 10 + c.try_cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))
    return rest == 1


def votes(span: Column, n_base: Column) -> dict[str, Column]:
    """What each labeler says of a span in a text with so many base spans: 1, 0 or -1."""
    value, kind, near = span["value"], span["kind"], F.lower(F.concat(span["before"], F.lit(" "), span["after"]))
    number = digits(value)

    def is_kind(*names: str) -> Column:
        return kind.isin([KINDS.index(n) for n in names])

    def say(yes: Column, no: Column | None = None) -> Column:
        return F.when(yes, 1).when(no if no is not None else F.lit(False), -1).otherwise(0)

    date = value.rlike(r"^(?:19|20)?[0-9]{2}[./\x20-][0-9]{1,2}[./\x20-](?:19|20)?[0-9]{2}$")
    one_digit = number.rlike(r"^([0-9])\1*$")
    shape = (
        F.when(is_kind("email", "ip"), 1).when(is_kind("card", "card_like"), say(F.call_function("luhn_check", number) & ~one_digit, F.lit(True)))
        .when(is_kind("phone", "phone_like"), say(value.rlike(rf"^(?:{NANP})$|^(?:\+|00)") & ~one_digit, date | one_digit))
        .when(is_kind("email_like"), say(value.rlike("[A-Za-z]{2,6}$"), F.lit(True)))
        .when(is_kind("account"), say(check97(value), F.lit(True)))
        .when(is_kind("identity"), say(~value.rlike("^(?:000|666|9)|-00-|-0000$"), F.lit(True)))
        .otherwise(say(value.rlike(r"\p{Ll}\x20\p{Lu}\p{Ll}+$"))))
    names = (
        F.when(is_kind("email", "email_like"), say(F.lower(value).rlike(f"(?:{listed(MAIL_ENDINGS)})$")))
        .when(is_kind("card", "card_like"), say(number.rlike(ISSUERS), F.lit(True)))
        .when(is_kind("phone", "phone_like"), say(value.rlike(CALLING) & ~value.rlike(TOLL_FREE), value.rlike(TOLL_FREE)))
        .when(is_kind("account"), say(value.rlike(f"^(?:{listed(ACCOUNT_COUNTRIES)})"), F.lit(True)))
        .when(is_kind("person"), say(value.rlike(rf"\b(?:{listed(GIVEN_NAMES)})\b"))).otherwise(0))
    context = say(near.rlike(rf"\b(?:{FOR})"), near.rlike(rf"\b(?:{AGAINST})"))
    return {"shape": shape, "gazetteer": names, "context": context, "company": say(n_base > (kind < BASE).cast("int"))}


LABELERS = ("shape", "gazetteer", "context", "company")


def features(span: Column, said: Column) -> Column:
    """Feature values as strings; each feature has at most BUCKETS values or those of a vote."""
    shape = F.regexp_replace(F.regexp_replace(span["value"], "[0-9]+", "9"), r"\p{L}+", "a")
    word = F.lower(F.regexp_extract(span["before"], r"(\p{L}+)[^\p{L}]*$", 1))
    return F.array(
        F.concat(F.lit("family="), F.array(*map(F.lit, FAMILIES))[span["kind"]]),
        F.concat(F.lit("digits="), F.least(F.length(digits(span["value"])), F.lit(BUCKETS - 1))),
        F.concat(F.lit("grouping="), F.crc32(shape.cast("binary")) % BUCKETS),
        F.concat(F.lit("length="), F.least(F.char_length(span["value"]), F.lit(BUCKETS - 1))),
        F.concat(F.lit("word="), F.crc32(word.cast("binary")) % BUCKETS),
        *(F.concat(F.lit(f"{name}="), said[name]) for name in LABELERS))


@dataclass
class Model:
    """Reliabilities: labeler -> vote -> (share among other spans, share among personal ones); weights of features."""

    prior: float = 0.0
    reliability: dict[str, dict[int, tuple[float, float]]] = field(default_factory=dict)
    posterior: dict[tuple[int, ...], float] = field(default_factory=dict)
    bias: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)


def maximised(patterns: dict[tuple[tuple[int, ...], bool], int], rounds: int = ROUNDS) -> Model:
    """Expectation-maximisation over counts of (votes, whether known as personal). Each vote has one
    pseudo-count on either side, so a labeler that never votes stays uncertain."""
    start = {1: (0.1, 0.7), 0: (0.6, 0.25), -1: (0.3, 0.05)}
    model = Model(0.5, {name: dict(start) for name in LABELERS})
    for _ in range(rounds):
        sums = {name: {v: [1.0, 1.0] for v in start} for name in LABELERS}
        weight = [1.0, 1.0]  # of spans that are not known
        for (said, known), n in patterns.items():
            p = 1.0 if known else posterior(model, said)
            if not known:
                weight[0] += n * (1 - p)
                weight[1] += n * p
            for name, v in zip(LABELERS, said, strict=True):
                sums[name][v][0] += n * (1 - p)
                sums[name][v][1] += n * p
        model.prior = weight[1] / sum(weight)
        for name, own in sums.items():
            total = [sum(s[z] for s in own.values()) for z in (0, 1)]
            model.reliability[name] = {v: (s[0] / total[0], s[1] / total[1]) for v, s in own.items()}
    model.posterior = {said: posterior(model, said) for said, _ in patterns}
    return model


def posterior(model: Model, said: tuple[int, ...]) -> float:
    odds = math.log(model.prior / (1 - model.prior))
    for name, v in zip(LABELERS, said, strict=True):
        other, personal = model.reliability[name][v]
        odds += math.log(personal / other)
    return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))


def voted(found: DataFrame) -> DataFrame:
    """A row per span: its votes, features and whether it is a base span."""
    spans = found.select(F.size("__base").alias("n_base"), F.explode(F.concat("__base", "__loose")).alias("span"))
    span = F.col("span")
    said = spans.select(span, *(v.alias(name) for name, v in votes(span, F.col("n_base")).items()))
    return said.select(
        (span["kind"] < BASE).alias("known"), *LABELERS,
        features(span, F.struct(*LABELERS)).alias("features"))


def train(found: DataFrame) -> Model | None:
    """From documents with spans (see `with_spans`); none without any."""
    rows = voted(found)
    patterns = {(tuple(r[name] for name in LABELERS), r["known"]): r["n"]
                for r in rows.groupBy("known", *LABELERS).agg(F.count("*").alias("n")).collect()}
    if not patterns:
        return None
    model = maximised(patterns)
    key = F.concat_ws(",", *LABELERS)
    soft = F.element_at(table_of({",".join(map(str, said)): p for said, p in model.posterior.items()}), key)
    weighed = rows.withColumn("p", F.when(F.col("known"), 1.0).otherwise(soft))
    sums = [F.sum(1 - F.col("p")).alias("other"), F.sum("p").alias("personal")]
    other, personal = weighed.agg(*sums).first()
    model.bias = math.log((personal + 1) / (other + 1))
    for r in weighed.select("p", F.explode("features").alias("feature")).groupBy("feature").agg(*sums).collect():
        values = 3 if r["feature"].split("=")[0] in LABELERS else BUCKETS
        model.weights[r["feature"]] = math.log((r["personal"] + 1) / (personal + values)) - math.log((r["other"] + 1) / (other + values))
    return model


def table_of(values: dict[str, float]) -> Column:
    return F.map_from_arrays(F.array(*map(F.lit, values)), F.array(*map(F.lit, values.values())))


def added(model: Model | None, base: Column, loose: Column) -> Column:
    """The loose spans that the classifier takes for personal."""
    if model is None:
        return loose
    weights = table_of(model.weights)

    def personal(span: Column) -> Column:
        said = F.struct(*(v.alias(name) for name, v in votes(span, F.size(base)).items()))
        score = F.aggregate(features(span, said), F.lit(float(model.bias)), lambda a, f: a + F.coalesce(F.try_element_at(weights, f), F.lit(0.0)))
        spoken = let(said, lambda s: F.greatest(*(s[name] for name in LABELERS[:3])) > 0)
        return spoken & (1 / (1 + F.exp(-score)) >= THRESHOLD)

    return F.when(F.size(loose) > 0, F.filter(loose, personal)).otherwise(loose)


def in_order(spans: Column) -> Column:
    return F.sort_array(F.transform(spans, lambda s: F.struct(*(s[c].alias(c) for c in ("start", "kind", "end", "value")))))


def named(spans: Column) -> Column:
    """kind:start:end of ordered spans, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def tag(documents: DataFrame) -> DataFrame:
    """The documents' ids with their spans in order, as (start, kind, end, value), and those of the base patterns."""
    found = staged(with_spans(documents).select(F.col("doc_id").cast("long").alias("doc_id"), "__base", "__loose"))
    extra = added(train(found), F.col("__base"), F.col("__loose"))
    return found.select("doc_id", in_order(F.col("__base")).alias("base"), in_order(F.concat("__base", extra)).alias("spans"))


def redact(documents: DataFrame, mark: str = "[private]") -> DataFrame:
    """The documents, all columns, with the union of all spans replaced. The texts are read twice: to train, and
    to replace."""
    columns = documents.columns
    model = train(staged(with_spans(documents).select("__base", "__loose")))
    found = with_spans(documents)
    spans = in_order(F.concat("__base", added(model, F.col("__base"), F.col("__loose"))))
    text = F.col("text").cast("string")

    def step(state, s):
        ahead = F.greatest(s["start"] - state["at"], F.lit(0))
        gap = F.concat(state["pieces"], F.when(ahead > 0, F.array(F.substr(text, state["at"] + 1, ahead))).otherwise(F.array().cast("array<string>")))
        opened = F.when((s["start"] >= state["at"]) | (F.size(state["pieces"]) == 0), F.concat(gap, F.array(F.lit(mark)))).otherwise(gap)
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), opened.alias("pieces"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("pieces"))
    clean = F.aggregate(spans, start, step, lambda s: F.concat(F.array_join(s["pieces"], ""), F.substr(text, s["at"] + 1)))
    return found.withColumn("__clean", F.when(F.size(spans) > 0, clean).otherwise(text)).select(
        *(F.col("__clean").alias(c) if c == "text" else F.col(f"`{c}`") for c in columns))


def op13_personal_data(spark, folder: str) -> DataFrame:
    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    found = tag(table(spark, folder, "documents"))
    counts = [count(k) for k in range(BASE)]
    return found.select("doc_id", *counts, F.sha2(named(F.col("base")), 256).alias("base_sha256"), named(F.col("spans")).alias("spans"))

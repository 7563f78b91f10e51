"""Private data replaced by keyed surrogates, with DataFrame functions alone.

One pattern splits a text into entities and the stretches between them. A surrogate is a function of a secret key,
the entity's canonical form and an attempt number, so equal entities get equal surrogates everywhere
(coreference). It is drawn once per form, without separators, and then poured into each spelling's separators: a number
written in two formats, or a title with and without a dot, stays one entity. It keeps the type: names follow the gender of their title and their script, numbers, keys and
passwords keep every separator, letter case and digit position, card numbers pass the Luhn test, addresses come
from reserved ranges and domains.

Collision check: over the distinct entities of the table, two entities must not share a surrogate, and no
surrogate may be an entity of the table. The loser gets the next attempt, until none is left. Attempts other than
0 follow from the rounds; the distinct entities never leave the executors, and reach the texts by joins. Each further
attempt adds a syllable to names and a character to mail domains, so that however many there are, all find a place.

Edge cases: a null text stays null, an empty one empty, both without entities. Repeated rows get the same text.
Extra columns pass through. ``n_entities`` takes the place of an input column of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlespark.llm.common import stored, text_key
from candlespark.session import materialize

# Titles and names by gender and script.
MALE_TITLES = ("Mr", "Herr", "Señor", "Monsieur", "господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Mme", "госпожа")
NEUTRAL_TITLES = ("Dr", "Prof")
MALE_NAMES = ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karim", "Leo", "Marco", "Nils", "Oscar", "Paul")
FEMALE_NAMES = ("Anna", "Berta", "Clara", "Diana", "Elena", "Flora", "Greta", "Helen", "Irene", "Julia", "Karin", "Laura", "Maria", "Nora", "Olga", "Paula")
NEUTRAL_NAMES = ("Alex", "Chris", "Dana", "Jo", "Kim", "Lee", "Robin", "Sascha")
SURNAME_STARTS = ("Al", "Bar", "Cor", "Dal", "El", "Far", "Gar", "Hal", "Is", "Jor", "Kel", "Lan", "Mar", "Nor", "Or", "Pel")
SURNAME_ENDS = ("berg", "den", "field", "gard", "ham", "kin", "land", "ley", "man", "mond", "ner", "son", "stein", "ton", "wald", "wick")
MALE_NAMES_CYRILLIC = ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Кирилл")
FEMALE_NAMES_CYRILLIC = ("Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Мария", "Ольга")
SURNAME_STARTS_CYRILLIC = ("Бел", "Вол", "Гор", "Дуб", "Зим", "Кар", "Лес", "Мор")
SURNAME_ENDS_MALE_CYRILLIC = ("анов", "енко", "ин", "ов")
SURNAME_ENDS_FEMALE_CYRILLIC = ("анова", "енко", "ина", "ова")

_TITLES = "|".join((*MALE_TITLES, *FEMALE_TITLES, *NEUTRAL_TITLES))
#: Type and pattern; the first type that matches at a place wins.
PATTERNS = (
    # A run of characters is tried once, from its start or from where the entity before it ended, and given back never: on long
    # texts without spaces anything else takes time with the square of their length.
    ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){1,30}+"),
    ("secret", r"\b(?i:password|passwd|api_?key|token|secret)\s{0,3}[=:]\s{0,3}[A-Za-z0-9_\-+/]{6,}|\"[0-9a-f]{32,64}\"|\bAKIA[0-9A-Z]{16}\b"),
    ("ip", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\d)"),
    ("phone", r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])"),
    ("card", r"(?<![\d])\d{4}([ -]?)\d{4}\1\d{4}\1\d{4}(?!\d)"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("name", rf"(?<!\p{{L}})(?:{_TITLES})\.? \p{{Lu}}\p{{Ll}}+(?: \p{{Lu}}\p{{Ll}}+)?"),
)
#: Types of which letters and digits count, not the separators.
NUMBERS = ("phone", "card", "iban", "ssn")
#: A country code: all lengths follow from the first digits.
COUNTRY = r"1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}"
ENTITY = "|".join(f"(?:{pattern})" for _, pattern in PATTERNS)
#: What any entity has; texts without it skip the long pattern.
HINT = rf"[0-9@]|(?i:password|passwd|api_?key|token|secret)|{_TITLES}"


def found(text: Column) -> Column:
    """Entities of a text in order."""
    none = F.array().cast("array<string>")
    return F.when(F.coalesce(text, F.lit("")).rlike(HINT), F.regexp_extract_all(text, F.lit(ENTITY), 0)).otherwise(none)


def kind(entity: Column) -> Column:
    out = F.lit("name")
    for name, pattern in reversed(PATTERNS[:-1]):
        out = F.when(entity.rlike(rf"^(?:{pattern})$"), name).otherwise(out)
    return out


def canonical(entity: Column, k: Column) -> Column:
    """The form in which entities are the same: type, then letters and digits that count.

    A phone's plus counts, as only with it the number starts with a country code. A title's dot does not.
    """
    form = (
        F.when(k == "email", F.lower(entity))
        .when(k.isin(*NUMBERS), F.regexp_replace(entity, r"[^0-9A-Za-z+]", ""))
        .when(k == "name", F.regexp_replace(entity, rf"^({_TITLES})\. ", "$1 "))
        .otherwise(entity)
    )
    return F.concat(k, F.lit(":"), form)


def pour(entity: Column, k: Column, surrogate: Column) -> Column:
    """A form's surrogate in the spelling of one of its entities: its separators, or its title's dot."""
    gaps = F.split(entity, "[0-9A-Za-z+]", -1)
    filled = F.zip_with(gaps, F.split(surrogate, ""), lambda gap, c: F.concat(gap, F.coalesce(c, F.lit(""))))
    dotted = F.regexp_replace(surrogate, rf"^({_TITLES}) ", "$1. ")
    return (
        F.when(k.isin(*NUMBERS), F.array_join(filled, ""))
        .when((k == "name") & entity.rlike(rf"^(?:{_TITLES})\. "), dotted)
        .otherwise(surrogate)
    )


def _number(digest: Column, place: Column | int, below: int) -> Column:
    """Number ``place`` of a 128-digit hex digest, each four digits."""
    start = (F.lit(place) if isinstance(place, int) else place) % 32 * 4 + 1
    return F.conv(digest.substr(start.cast("int"), F.lit(4)), 16, 10).cast("int") % below


def _pick(values: tuple[str, ...], digest: Column, place: int) -> Column:
    return F.get(F.array(*map(F.lit, values)), _number(digest, place, len(values)))


def _alike(text: Column, digest: Column) -> Column:
    """Digits for digits, letters for letters of the same case and script (hex letters for hex digits)."""
    hexes = text.rlike("^[^g-zG-Z]*$") & text.rlike("[0-9]")

    def swap(c: Column, i: Column) -> Column:
        n = _number(digest, i, 60_000)
        return (
            F.when(c.rlike("[0-9]"), (n % 10).cast("string"))
            .when(c.rlike("[a-z]"), F.char(97 + F.when(hexes, n % 6).otherwise(n % 26)))
            .when(c.rlike("[A-Z]"), F.char(65 + F.when(hexes, n % 6).otherwise(n % 26)))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), swap), "")


def _luhn(number: Column) -> Column:
    """The last digit replaced by the one that makes the digits before it pass the Luhn test."""
    digits = F.regexp_replace(number, "[^0-9]", "")
    front = F.reverse(digits.substr(F.lit(1), F.length(digits) - 1))

    def weigh(total: Column, x: Column) -> Column:
        doubled = x["d"] * F.when(x["i"] % 2 == 0, 2).otherwise(1)
        return total + F.when(doubled > 9, doubled - 9).otherwise(doubled)

    placed = F.transform(F.split(front, ""), lambda c, i: F.struct(c.cast("int").alias("d"), i.alias("i")))
    check = (10 - F.aggregate(placed, F.lit(0), weigh) % 10) % 10
    return F.concat(number.substr(F.lit(1), F.length(number) - 1), check.cast("string"))


def _more(values: tuple[str, ...], digest: Column) -> Column:
    """As many further syllables as the attempt's number."""
    places = F.when(F.col("attempt") > 0, F.sequence(F.lit(4), F.col("attempt") + 3)).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, lambda i: F.get(F.array(*map(F.lit, values)), _number(digest, i, len(values)))), "")


def _name(entity: Column, digest: Column) -> Column:
    title = F.regexp_extract(entity, rf"^((?:{_TITLES})\.?) ", 1)
    bare = F.regexp_replace(title, r"\.", "")
    male, female = bare.isin(*MALE_TITLES), bare.isin(*FEMALE_TITLES)
    cyrillic = F.regexp_replace(entity, rf"^(?:{_TITLES})\.? ", "").rlike(r"\p{IsCyrillic}")
    first = (
        F.when(cyrillic & female, _pick(FEMALE_NAMES_CYRILLIC, digest, 0))
        .when(cyrillic, _pick(MALE_NAMES_CYRILLIC, digest, 0))
        .when(male, _pick(MALE_NAMES, digest, 0))
        .when(female, _pick(FEMALE_NAMES, digest, 0))
        .otherwise(_pick(NEUTRAL_NAMES, digest, 0))
    )
    latin = F.concat(_pick(SURNAME_STARTS, digest, 1), _pick(SURNAME_STARTS, digest, 2), _more(SURNAME_STARTS, digest), _pick(SURNAME_ENDS, digest, 3))
    slavic = F.concat(
        _pick(SURNAME_STARTS_CYRILLIC, digest, 1),
        _more(SURNAME_STARTS_CYRILLIC, digest),
        F.when(female, _pick(SURNAME_ENDS_FEMALE_CYRILLIC, digest, 3)).otherwise(_pick(SURNAME_ENDS_MALE_CYRILLIC, digest, 3)),
    )
    last = F.concat(F.substring(F.when(cyrillic, slavic).otherwise(latin), 1, 1), F.lower(F.substring(F.when(cyrillic, slavic).otherwise(latin), 2, 400)))
    two = F.size(F.split(F.regexp_replace(entity, rf"^(?:{_TITLES})\.? ", ""), " ")) > 1
    return F.concat(title, F.lit(" "), F.when(two, F.concat(first, F.lit(" "), last)).otherwise(last))


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """Adds ``surrogate`` to rows of ``entity, kind, form, attempt``, where ``entity`` is the form without its type."""
    # Columns in layers: each is computed once per entity, however often the next layer reads it.
    entity, digest = F.col("entity"), F.col("digest")
    df = entities.withColumn("digest", F.sha2(F.concat_ws("|", F.lit(key), F.col("attempt").cast("string"), "form"), 512))
    at = F.instr(entity, "@")
    lead = (
        F.when(F.col("kind") == "email", "")
        .when(F.col("kind") == "secret", F.regexp_extract(entity, r"^(AKIA|\"|\w+\s*[=:]\s*)", 1))
        .when(F.col("kind") == "phone", F.regexp_extract(entity, rf"^(\+(?:{COUNTRY})|)", 1))
        .when(F.col("kind") == "card", F.substring(entity, 1, 1))
        .when(F.col("kind") == "iban", F.substring(entity, 1, 2))
        .otherwise("")
    )
    df = df.withColumn("lead", lead)
    body = F.when(F.col("kind") == "email", F.lower(entity.substr(F.lit(1), at - 1))).otherwise(entity.substr(F.length("lead") + 1, F.length(entity)))
    df = df.withColumn("body", body).withColumn("label", F.lower(F.regexp_extract(entity, r"@([A-Za-z0-9-]+)", 1)))
    df = df.withColumn("alike", F.concat("lead", _alike(F.col("body"), digest)))
    longer = digest.substr(F.lit(65), F.col("attempt"))
    df = df.withColumn("label_alike", F.concat(_alike(F.col("label"), F.reverse("digest")), longer))
    top = F.when(F.lower(entity).rlike(r"\.(net|org)$"), F.lower(F.regexp_extract(entity, r"\.([A-Za-z]+)$", 1))).otherwise(F.lit("com"))
    address = F.concat_ws(".", *[(_number(digest, i, n) + low).cast("string") for i, (n, low) in enumerate(((15, 240), (256, 0), (256, 0), (254, 1)))])
    new = (
        F.when(F.col("kind") == "email", F.concat("alike", F.lit("@"), "label_alike", F.lit(".example."), top))
        .when(F.col("kind") == "ip", address)
        .when(F.col("kind") == "card", _luhn(F.col("alike")))
        .when(F.col("kind") == "name", _name(entity, digest))
        .otherwise(F.col("alike"))
    )
    return df.withColumn("surrogate", new).drop("digest", "lead", "body", "label", "alike", "label_alike")


def attempts(entities: DataFrame, key: str, most: int = 50) -> DataFrame:
    """``form, kind, entity, attempt``: the first attempt by which every form has a surrogate of its own.

    ``entities``: ``kind, form``; the result's ``entity`` is the form without its type. Rounds go on until no two forms share a surrogate and none equals an entity
    of the table; each round writes its state.
    """
    bare = F.col("form").substr(F.length("kind") + 2, F.length("form"))
    state = entities.select("form", "kind").distinct().withColumns({"entity": bare, "attempt": F.lit(0)})
    rows = entities.count()
    state = stored(state, "pii-forms", rows)
    forms = state.select(F.col("form").alias("mark"))
    for _ in range(most):
        given = surrogates(state, key).withColumn("mark", canonical(F.col("surrogate"), F.col("kind")))
        given = stored(given.select("form", "attempt", "mark"), "pii-marks", rows)
        shared = given.groupBy("mark").agg(F.min(F.struct("attempt", "form")).alias("first"), F.count("*").alias("n")).filter("n > 1")
        real = given.join(forms, "mark", "left_semi").select("mark", F.lit(None).cast("string").alias("winner"))
        contested = shared.select("mark", F.col("first.form").alias("winner")).join(real, "mark", "left_anti").unionByName(real.distinct())
        losers = given.join(contested, "mark").filter("winner IS NULL OR winner <> form").select("form")
        losers = stored(losers.distinct(), "pii-collisions", rows)
        if losers.isEmpty():
            return state
        raised = state.join(losers.withColumn("more", F.lit(1)), "form", "left").withColumn("attempt", F.col("attempt") + F.coalesce("more", F.lit(0)))
        state = stored(raised.select("form", "kind", "entity", "attempt"), "pii-forms", rows)
    raise RuntimeError(f"{most} attempts left surrogates that collide; the table has more entities of a type than its format allows")


def protect(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with ``text`` replaced and ``n_entities`` added."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    marked = docs.select(row.alias("packed_row"), "text", found(F.col("text")).alias("entities"))
    clean, held = marked.filter(F.size("entities") == 0), marked.filter(F.size("entities") > 0)
    # Which text holds which entity; copies of a text count once. Texts themselves are not moved here.
    occurring = held.select(text_key(F.col("text")).alias("text_key"), F.explode("entities").alias("entity")).distinct()
    occurring = materialize(occurring, "pii-occurrences")
    rows = occurring.count()
    entities = occurring.select("entity").distinct().withColumn("kind", kind(F.col("entity")))
    entities = stored(entities.withColumn("form", canonical(F.col("entity"), F.col("kind"))), "pii-entities", rows)
    drawn = surrogates(attempts(entities, key), key).select("form", "surrogate")
    given = entities.join(drawn, "form").select("entity", pour(F.col("entity"), F.col("kind"), F.col("surrogate")).alias("surrogate"))
    per_text = occurring.join(given, "entity").groupBy("text_key").agg(F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias("given"))
    # Only texts with entities are shuffled.
    held = held.withColumn("text_key", text_key(F.col("text"))).join(per_text, "text_key")
    new = F.transform("entities", lambda e: F.col("given")[e])
    woven = F.zip_with(F.split("text", ENTITY, -1), new, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    replaced = held.select("packed_row", F.array_join(woven, "").alias("new_text"), F.size("entities").alias("n_found"))
    out = replaced.unionByName(clean.select("packed_row", F.col("text").alias("new_text"), F.lit(0).alias("n_found")))
    columns = [F.col("new_text").alias(c) if c.lower() == "text" else F.col(f"packed_row.`{c}`") for c in docs.columns if c.lower() != "n_entities"]
    return out.select(*columns, F.col("n_found").alias("n_entities"))

"""Personal data replaced by keyed surrogates, with DataFrame functions only.

E-mail and IP addresses, phone, card and social security numbers, IBANs and names of persons (after a
form of address, or begun by a known given name) are found in whole texts. Each is reduced to a
canonical form, so that spellings of one entity, +1 (269) 555-3296 and +1 269 555 3296, share it; of
a person's name, the given names and the family name are entities of their own, so that Mr John Smith
and Mr Smith keep sharing theirs.

An entity's surrogate is drawn by a keyed SHA-256 of its kind and canonical form. It keeps the type
and format: separators, letter case and length; the country code of a phone number or IBAN; the
issuer's digit and the check digit of a card number; gender and script of a given name, the script of
a family name. All different entities of the corpus are then compared: where two have the same
surrogate, or one has another entity's canonical form, all but one draw again, until all surrogates
are distinct and no entity's own. Spellings of one entity stay one, across all documents, and
different ones stay different.

Documents without entities pass through untouched and unshuffled; the others are joined with their
entities' surrogates, so a text is rebuilt from the pieces between entities and the new ones.

Defined results: a null text stays null, an empty one empty, both without entities. Rows with equal
id and text have equal results; null ids are ids like any other. Empty tables give empty tables, other
columns are neither read nor kept. An entity may occur in any number of documents; none is capped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from periodica.llm.common import stored, table

KEY = "periodica"
MAX_DRAWS = 60
HEX = "0123456789abcdef"

# Forms of address by gender, given names by script and gender, syllables by script.
MALE = ["Mr", "Herr", "M", "Sr", "Señor", "Don", "г-н", "κ"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Mme", "Mlle", "Sra", "Señora", "Doña", "г-жа", "κα"]
EITHER = ["Dr", "Prof"]
GIVEN = {
    ("latin", "m"): ["James", "Robert", "Michael", "Thomas", "Daniel", "Paul", "Peter", "Martin",
                     "Carlos", "Pierre", "Hans", "Luis", "George", "Henry", "Walter", "Simon"],
    ("latin", "f"): ["Mary", "Linda", "Susan", "Anna", "Julia", "Laura", "Clara", "Helen",
                     "Carmen", "Marie", "Greta", "Lucia", "Alice", "Emma", "Nora", "Ruth"],
    ("cyrillic", "m"): ["Иван", "Пётр", "Сергей", "Андрей", "Павел", "Николай", "Олег", "Юрий"],
    ("cyrillic", "f"): ["Анна", "Мария", "Ольга", "Елена", "Ирина", "Наталья", "Вера", "Софья"],
    ("greek", "m"): ["Γιώργος", "Νίκος", "Γιάννης", "Κώστας", "Πέτρος", "Παύλος", "Ανδρέας", "Μάριος"],
    ("greek", "f"): ["Μαρία", "Ελένη", "Άννα", "Σοφία", "Κατερίνα", "Ειρήνη", "Δήμητρα", "Χριστίνα"],
}
SYLLABLES = {
    "latin": ["ba", "bel", "cor", "da", "den", "far", "gan", "hol", "ka", "ler", "lin", "mar", "ner",
              "or", "pel", "ra", "ren", "sal", "ton", "ver"],
    "cyrillic": ["ба", "вел", "гор", "да", "ден", "жар", "зан", "кол", "ла", "лер", "мин", "мар",
                 "нер", "ор", "пел", "ра", "рен", "сал", "тон", "вер"],
    "greek": ["βα", "βελ", "γορ", "δα", "δεν", "ζαρ", "θαν", "κολ", "λα", "λερ", "μιν", "μαρ",
              "νερ", "ορ", "πελ", "ρα", "ρεν", "σαλ", "τον", "φερ"],
}

OCTET = r"(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
EMAIL = r"(?<![\p{L}0-9._%+-])[\p{L}0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IP = rf"(?<![0-9A-Za-z.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9A-Za-z]|\.[0-9])"
IBAN = r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])"
SSN = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
CARD = r"(?<![0-9A-Za-z+-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z-])"
PHONE = (
    r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)[ .-]?)?[0-9]{2,4}(?:[ .-]?[0-9]{2,4}){1,3}"
    r"|\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4})(?![0-9A-Za-z])"
)
ADDRESS = "(?:" + "|".join(sorted(MALE + FEMALE + EITHER, key=len, reverse=True)) + ")"
KNOWN = "(?:" + "|".join(n for names in GIVEN.values() for n in names) + ")"
CAPITAL = r"\p{Lu}[\p{L}'’-]+"
NAME = (
    rf"(?<![\p{{L}}0-9])(?:{ADDRESS}\.? {CAPITAL}(?: {CAPITAL}){{0,2}}|{KNOWN}(?: {CAPITAL}){{1,2}})"
)
ENTITY = "|".join([EMAIL, IP, IBAN, SSN, CARD, PHONE, NAME])
# what any entity has: two digits in sight of each other, an @, or a form of address or a given name
HINT = rf"@|[0-9][ ().-]{{0,3}}[0-9]|(?<![\p{{L}}0-9])(?:{ADDRESS}\.? |{KNOWN} )\p{{Lu}}"


def one_of(values: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in values])


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn_valid(number: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    back = F.split(F.reverse(number), "")
    values = F.transform(back, lambda x, i: x.cast("int") * (1 + i % 2))
    total = F.aggregate(values, F.lit(0), lambda acc, x: acc + x - F.when(x > 9, 9).otherwise(0))
    return total % 10 == 0


def luhn_digit(front: Column) -> Column:
    """The check digit that belongs behind a string of digits."""
    back = F.split(F.reverse(front), "")
    values = F.transform(back, lambda x, i: x.cast("int") * (2 - i % 2))
    total = F.aggregate(values, F.lit(0), lambda acc, x: acc + x - F.when(x > 9, 9).otherwise(0))
    return ((10 - total % 10) % 10).cast("string")


def piece(text: Column, kind: Column) -> Column:
    return F.struct(text.alias("text"), kind.alias("kind"))


def kind_of(match: Column) -> Column:
    return (
        F.when(match.rlike("@"), "email")
        .when(match.rlike(rf"^(?:{OCTET}\.){{3}}{OCTET}$"), "ip")
        .when(match.rlike("^[A-Z]{2}[0-9]{2}"), "iban")
        .when(match.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(match.rlike("^[+(]"), "phone")
        .when(match.rlike("^[0-9]") & (F.length(digits(match)) >= 13), "card")
        .when(match.rlike("^[0-9]"), "phone")
        .otherwise("name")
    )


def script_of(word: Column) -> Column:
    return (
        F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic")
        .when(word.rlike(r"\p{IsGreek}"), "greek")
        .otherwise("latin")
    )


def name_pieces(match: Column) -> Column:
    """Words of a name: forms of address as they are, given names with gender, then the family name."""
    words = F.split(match, " ")
    address = F.regexp_replace(F.element_at(words, 1), r"\.$", "")
    addressed = address.isin(MALE + FEMALE + EITHER)
    men = [n for (_, g), names in GIVEN.items() if g == "m" for n in names]
    women = [n for (_, g), names in GIVEN.items() if g == "f" for n in names]
    first = F.when(addressed, F.get(words, F.lit(1))).otherwise(F.element_at(words, 1))
    gender = (
        F.when(address.isin(MALE) | first.isin(men), "m")
        .when(address.isin(FEMALE) | first.isin(women), "f")
        .otherwise("x")
    )

    def one(word: Column, i: Column) -> Column:
        kind = F.concat_ws(
            ":",
            F.when(i == F.size(words) - 1, "family").otherwise("given"),
            script_of(word),
            F.when(i < F.size(words) - 1, gender),
        )
        own = piece(word, F.when((i == 0) & addressed, None).otherwise(kind))
        blank = piece(F.lit(" "), F.lit(None).cast("string"))
        return F.when(i == 0, F.array(own)).otherwise(F.array(blank, own))

    return F.flatten(F.transform(words, one))


def pieces_of(text: Column) -> Column:
    """The text as an array of (text, kind); kind is null for what stays as it is."""
    gaps, matches = F.split(text, ENTITY, -1), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))

    def both(gap: Column, match: Column) -> Column:
        kind = kind_of(match)
        rest = F.when(kind == "name", name_pieces(match)).otherwise(F.array(piece(match, kind)))
        plain = F.array(piece(gap, F.lit(None).cast("string")))
        return F.when(match.isNull(), plain).otherwise(F.concat(plain, rest))

    return F.flatten(F.zip_with(gaps, matches, both))


def canonical(text: Column, kind: Column) -> Column:
    """What spellings of one entity share."""
    return (
        F.when(kind.isin("phone", "card", "ssn"), digits(text))
        .when(kind == "iban", F.regexp_replace(text, " ", ""))
        .when(kind == "ip", F.concat_ws(".", F.transform(F.split(text, r"\."), lambda x: x.cast("int").cast("string"))))
        .otherwise(F.lower(text))
    )


def numbers_from(digest: Column) -> Column:
    """Forty-eight decimal digits of a SHA-256 in hex."""
    parts = [
        F.lpad(F.right(F.conv(F.substring(digest, 1 + 15 * i, 15), 16, 10), F.lit(12)), 12, "0")
        for i in range(4)
    ]
    return F.concat(*parts)


def spelled(shape: Column, numbers: Column, letters: Column) -> Column:
    """`shape` with each digit and letter replaced by those of two strings, in turn; case is kept."""

    def one(c: Column, i: Column) -> Column:
        at = (i % 48) + 1
        letter = F.substring(letters, at, F.lit(1))
        return (
            F.when(c.rlike("[0-9]"), F.substring(numbers, at, F.lit(1)))
            .when(c.rlike(r"\p{Ll}"), letter)
            .when(c.rlike(r"\p{L}"), F.upper(letter))
            .otherwise(c)
        )

    return F.concat_ws("", F.transform(F.split(shape, ""), one))


def drawn(kind: Column, canon: Column, draw: Column, key: str) -> Column:
    """The surrogate's canonical form for one draw."""
    digest = F.sha2(F.concat_ws("|", F.lit(key), kind, canon, draw.cast("string")), 256)
    host = F.element_at(F.split(canon, "@"), -1)
    host_digest = F.sha2(F.concat_ws("|", F.lit(key), F.lit("host"), host), 256)
    numbers = numbers_from(digest)
    letters = F.translate(digest, HEX, "cdefghklmnoprstu")
    host_letters = F.translate(host_digest, HEX, "bcdfghklmnprstvz")
    n = F.length(canon)
    front = F.concat(F.substring(canon, F.lit(1), F.lit(1)), F.substring(numbers, F.lit(1), n - 2))
    card = F.when(luhn_valid(canon), F.concat(front, luhn_digit(front))).otherwise(
        F.concat(front, F.substring(numbers, n, F.lit(1)))
    )
    local = spelled(F.element_at(F.split(canon, "@"), 1), numbers, letters)
    # many draws for one short local part: it needs more room
    local = F.concat(local, F.when(draw >= 4, F.substring(letters, F.lit(49), F.lit(4))).otherwise(""))
    top = F.element_at(F.split(host, r"\."), -1)
    email = F.concat(local, F.lit("@"), F.substring(host_letters, 1, 8), F.lit(".example."), top)
    octets = [F.conv(F.substring(digest, 1 + 2 * i, 2), 16, 10).cast("int") for i in range(4)]
    ip = F.concat_ws(".", 1 + octets[0] % 223, *octets[1:])
    country = F.greatest(n - 10, F.lit(1))
    area = (2 + F.substring(numbers, 1, 1).cast("int") % 8).cast("string")
    tail = F.concat(area, F.substring(numbers, F.lit(2), n))
    phone = F.concat(
        F.substring(canon, F.lit(1), F.when(n > 10, country).otherwise(0)),
        F.substring(tail, F.lit(1), F.when(n > 10, n - country).otherwise(n)),
    )
    iban = F.concat(F.substring(canon, 1, 2), spelled(F.substring(canon, F.lit(3), n), numbers, letters))
    out = (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "card", card)
        .when(kind == "ssn", F.concat(F.lit("9"), F.substring(numbers, 1, 8)))
        .when(kind == "iban", iban)
        .when(kind == "phone", phone)
    )
    at = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    for script, syllables in SYLLABLES.items():
        picks = [
            F.get(one_of(syllables), F.conv(F.substring(digest, 9 + 4 * i, 4), 16, 10).cast("int") % 20)
            for i in range(10)
        ]
        # a longer name with every other draw: there are enough for any number of entities
        family = F.concat_ws("", F.slice(F.array(*picks), F.lit(1), F.least(3 + draw / 2, F.lit(10)).cast("int")))
        out = out.when(kind == f"family:{script}", family)
        for gender in ("m", "f", "x"):
            names = GIVEN[script, "m"] + GIVEN[script, "f"] if gender == "x" else GIVEN[script, gender]
            given = F.lower(F.get(one_of(names), (at % len(names)).cast("int")))
            more = F.concat_ws("", F.slice(F.array(*picks), F.lit(1), F.least(draw, F.lit(8))))
            out = out.when(
                kind == f"given:{script}:{gender}",
                F.when(draw == 0, given).otherwise(F.concat(given, F.lit("-"), more)),
            )
    return out


def written(kind: Column, text: Column, surrogate: Column) -> Column:
    """A surrogate in the format of one spelling of its entity."""

    def nth(c: Column, i: Column) -> Column:
        before = F.length(digits(F.substring(text, F.lit(1), i + 1)))
        return F.when(c.rlike("[0-9]"), F.substring(surrogate, before, F.lit(1))).otherwise(c)

    def grouped(c: Column, i: Column) -> Column:
        at = F.length(F.regexp_replace(F.substring(text, F.lit(1), i + 1), " ", ""))
        return F.when(c == " ", c).otherwise(F.substring(surrogate, at, F.lit(1)))

    letters = F.split(text, "")
    upper = (F.upper(text) == text) & (F.length(text) > 1)
    rest = F.substring(surrogate, F.lit(2), F.length(surrogate))
    capital = F.concat(F.upper(F.substring(surrogate, 1, 1)), rest)
    return (
        F.when(kind.isin("phone", "card", "ssn"), F.concat_ws("", F.transform(letters, nth)))
        .when(kind == "iban", F.concat_ws("", F.transform(letters, grouped)))
        .when(kind == "ip", surrogate)
        .when(upper, F.upper(surrogate))
        .when(kind == "email", surrogate)
        .otherwise(capital)
    )


def surrogates(entities: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, canon, surrogate) for the different entities (kind, canon): distinct within a kind and
    never the canonical form of an entity of that kind."""
    held = stored(entities.select("kind", "canon", F.lit(0).alias("draw")).distinct())
    for _ in range(MAX_DRAWS):
        now = held.withColumn("surrogate", drawn(F.col("kind"), F.col("canon"), F.col("draw"), key))
        now = stored(now)
        first = now.groupBy("kind", "surrogate").agg(
            F.count("*").alias("n"), F.min(F.struct("draw", "canon")).alias("holder")
        )
        taken = held.select(F.col("kind").alias("k"), F.col("canon").alias("own"))
        same = (F.col("kind") == F.col("k")) & (F.col("surrogate") == F.col("own"))
        real = first.join(taken, same, "left_semi").select("kind", "surrogate", F.lit(None).alias("keeps"))
        clash = first.filter("n > 1").select("kind", "surrogate", F.col("holder.canon").alias("keeps"))
        bad = clash.join(real.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti").unionByName(real)
        bad = bad.select("kind", "surrogate", "keeps", F.lit(True).alias("again"))
        marked = now.join(bad, ["kind", "surrogate"], "left")
        # a name that keeps its place keeps its draw
        again = F.coalesce("again", F.lit(False)) & ~F.coalesce(F.col("canon") == F.col("keeps"), F.lit(False))
        nxt = stored(marked.select("kind", "canon", "surrogate", again.alias("redraw"), "draw"))
        if nxt.filter("redraw").isEmpty():
            return nxt.select("kind", "canon", "surrogate")
        held = nxt.select("kind", "canon", (F.col("draw") + F.col("redraw").cast("int")).alias("draw"))
    raise ValueError("no distinct surrogates after as many draws as allowed")


def pseudonymised(
    docs: DataFrame, key: str = KEY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of `docs`: doc_id, text with surrogates, n_entities, kinds (a map of counts)."""
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text")
    )
    hinted = F.coalesce(F.col("text").rlike(HINT), F.lit(False))
    found = rows.filter(hinted).withColumn("pieces", pieces_of(F.col("text")))
    found = stored(
        found.select("doc_id", F.xxhash64("text", F.length("text")).alias("text_key"), "pieces")
    )
    none = F.create_map().cast("map<string,bigint>")
    untouched = rows.filter(~hinted).select(
        "doc_id", "text", F.lit(0).cast("long").alias("n_entities"), none.alias("kinds")
    )

    parts = found.select("doc_id", "text_key", F.posexplode("pieces").alias("at", "piece"))
    parts = parts.filter("piece.kind is not null").distinct()
    kind, spelling = F.col("piece.kind"), F.col("piece.text")
    parts = parts.select(
        "doc_id", "text_key", "at", spelling.alias("spelling"), kind.alias("kind"), canonical(spelling, kind).alias("canon")
    )
    known = surrogates(parts, key)
    parts = parts.join(known, ["kind", "canon"])
    new = written(F.col("kind"), F.col("spelling"), F.col("surrogate")).alias("new")
    parts = parts.select("doc_id", "text_key", "at", new).groupBy("doc_id", "text_key")
    # as many as the entities of one text
    parts = parts.agg(F.map_from_entries(F.collect_list(F.struct("at", "new"))).alias("news"))
    parts = parts.select(F.col("doc_id").alias("id"), F.col("text_key").alias("of"), "news")
    match = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_key") == F.col("of"))
    joined = found.join(parts, match, "left")
    words = F.transform(
        "pieces", lambda x, i: F.coalesce(F.try_element_at(F.col("news"), i), x["text"])
    )
    kinds = F.filter(F.transform("pieces", lambda x: F.split(x["kind"], ":")[0]), lambda x: x.isNotNull())
    counts = F.map_from_entries(
        F.transform(
            F.array_sort(F.array_distinct(kinds)),
            lambda k: F.struct(k, F.size(F.filter(kinds, lambda x: x == k)).cast("long")),
        )
    )
    touched = joined.select(
        "doc_id", F.concat_ws("", words).alias("text"), F.size(kinds).cast("long").alias("n_entities"),
        counts.alias("kinds"),
    )
    return untouched.unionByName(touched)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymised(table(spark, sf_dir, "documents"))


QUERIES = {"op6_pii": op6_pii}
ORACLE: dict[str, str] = {}

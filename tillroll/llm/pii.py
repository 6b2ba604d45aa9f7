"""Personal data and secrets are replaced by surrogates, with Spark expressions only.

Patterns find mentions of emails, IP addresses (both versions), phone, card, account and social security numbers,
secrets, and persons named with a title. A mention is made of units: a number's digits, a given name,
a surname. A unit's surrogate is drawn from a keyed hash of its kind and normal form, so that the same
unit has the same surrogate in every document. It is of the same kind and format: digits for digits,
letters for letters, the same case and separators; names keep script and the gender that the titles
before them tell in all documents (a given name with titles of both, or of none, is neutral). Of a
secret, nothing is kept but the public prefix of a token.

Distinct units get distinct surrogates, and none that is itself a unit of the corpus: units whose
surrogate is taken draw again, the first by number of draws and value keeping it, until no two agree.
Late draws are longer than the value, so that there is room however many units there are.

Every text is searched once and kept cut at its mentions; it is joined again around the surrogates,
so that surrogates are never searched. Only texts with a mention are shuffled.

Defined cases: a NULL or empty text stays as it is; a masked secret, without a letter or digit, stays;
equal mentions and repeated rows are replaced alike; an empty table gives no rows; all columns are
kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.staging import staged

_MAX_DRAWS = 64
_GROWS_AT = 8
_GAP = r"[^\p{L}\p{N}\n]{1,6}"
_NAME = r"(?:\p{Lu}\p{Ll}+|\p{Lu}{2,})(?:-\p{Lu}\p{L}+)?"
# Titles by the gender that they tell.
TITLES = {
    "f": ["Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Sra", "Señora", "г-жа", "Госпожа"],
    "m": ["Mr", "Herr", "Monsieur", "Sr", "Señor", "г-н", "Господин"],
    "n": ["Dr", "Prof"],
}
# Given names by gender and script; "n" goes with either gender.
GIVEN_NAMES = {
    "f": ["Ada", "Clara", "Elena", "Flora", "Greta", "Ida", "Julia", "Laura", "Marta", "Nora", "Rosa", "Vera"],
    "m": ["Adrian", "Bruno", "David", "Felix", "Hugo", "Jonas", "Leo", "Martin", "Oscar", "Paul", "Simon", "Victor"],
    "n": ["Alex", "Charlie", "Jules", "Kim", "Noel", "Robin", "Sam", "Toni"],
    "f-cyrillic": ["Анна", "Вера", "Дарья", "Елена", "Ирина", "Мария", "Ольга", "Софья"],
    "m-cyrillic": ["Антон", "Борис", "Виктор", "Иван", "Лев", "Максим", "Олег", "Павел"],
    "n-cyrillic": ["Саша", "Женя", "Валя", "Шура"],
}
_SYLLABLES = {
    "latin": ["ba", "den", "fi", "gor", "hal", "ke", "lin", "mar", "no", "pel", "ri", "san", "tor", "ul", "ven", "wi"],
    "cyrillic": ["ба", "ден", "фи", "гор", "хал", "ке", "лин", "мар", "но", "пел", "ри", "сан", "тор", "ул", "вен", "зи"],
}
_TITLE = "(?:" + "|".join(title for titles in TITLES.values() for title in titles) + ")"
# What stands before a secret and stays: a key word with "=" or ":", or the header of a PEM block.
_PASSWORD = r"(?i:password|passwd|pwd|passphrase|passwort|kennwort|mot de passe|contraseña|пароль)"
_KEY_WORD = r"(?i:(?:[a-z]+[_-])*(?:token|secret|(?:api|access|secret|private)[ _-]?key)|clave|schlüssel|clé|ключ)"
_ASSIGN, _QUOTE = r"[\"']?[ \t]{0,3}[:=][ \t]{0,3}", r"[\"']?"
_PEM = r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----"
_LEAD = rf"(?:{_PEM}|(?:{_PASSWORD}|{_KEY_WORD}){_ASSIGN}{_QUOTE})"
_VALUE = r"[^\s\"'<>,;]"
# Forms of tokens, and the prefixes that tell whose they are.
_TOKENS = [
    "AKIA[0-9A-Z]{16}",
    "(?:sk-|gh[pousr]_|github_pat_|xox[abp]-)[0-9A-Za-z_-]{16,}",
    r"eyJ[0-9A-Za-z_-]{5,}\.[0-9A-Za-z_-]{5,}(?:\.[0-9A-Za-z_-]*)?",
]
_PREFIX = "^(?:AKIA|sk-|gh[pousr]_|github_pat_|xox[abp]-|eyJ)"
# A telephone number in any grouping; a date, a social security or a card number that begins with 0 is none.
_DIGIT_GAP = r"[ \u00A0\u202F./()-]{0,3}"
_NO_PHONE = (
    r"(?!0[1-9][./-](?:0?[1-9]|1[0-2])[./-](?:19|20)?\d{2}(?!\d|[./-]\d))"
    r"(?!\d{3}-\d{2}-\d{4}(?![\p{N}-]))(?!\d(?:[ -]?\d){15,18}(?!\p{N}))(?!0[.]\d)"
)
_HEXTETS = r"[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4})"
# In order of precedence. A pattern neither begins nor ends within a longer word or number.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}",
    "secret": rf"(?<![\p{{L}}\p{{N}}])(?:[0-9a-fA-F]{{32,128}}|{'|'.join(_TOKENS)})(?![\p{{L}}\p{{N}}])"
    rf"|{_PEM}(?:[^-]++(?:-(?!----)[^-]*+)*+(?=-----END)|(?:\s*[A-Za-z0-9+/=]{{40,}})+)"
    rf"|(?<![\p{{L}}\p{{N}}])(?:{_PASSWORD}{_ASSIGN}{_QUOTE}{_VALUE}{{4,}}"
    rf"|{_KEY_WORD}{_ASSIGN}{_QUOTE}(?={_VALUE}*[0-9]){_VALUE}{{8,}})"
    r"|(?<![\p{L}\p{N}+/])(?=[A-Za-z0-9+/]{0,39}[0-9])(?=[A-Za-z0-9+/]{0,39}[a-z])(?=[A-Za-z0-9+/]{0,39}[A-Z])"
    r"[A-Za-z0-9+/]{40}(?![\p{L}\p{N}+/])",
    "ip6": rf"(?<![\p{{L}}\p{{N}}:.])(?:{_HEXTETS}{{7}}|(?=[a-fA-F:]{{0,38}}[0-9])(?:{_HEXTETS}{{0,5}})?::(?:{_HEXTETS}{{0,5}})?)(?![\p{{L}}\p{{N}}:]|\.\p{{N}})",
    "ip": r"(?<![\p{N}.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\p{N})",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "phone": rf"\+\d{{1,3}}{_GAP}\d{{2,4}}{_GAP}\d{{3}}[-. ]?\d{{4}}(?!\p{{N}})"
    r"|\+\d{9,14}(?!\p{N})|(?<![\p{L}\p{N}])\(?\d{3}\)?[-. ]\d{3}[-. ]\d{4}(?!\p{N})"
    rf"|(?<![\p{{L}}\p{{N}}+])\+\(?\d(?:{_DIGIT_GAP}\d){{6,14}}(?!\p{{N}})"
    rf"|(?<![\p{{L}}\p{{N}}.,:/_#-])\(?{_NO_PHONE}0(?:{_DIGIT_GAP}\d){{6,14}}(?!\p{{N}})",
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{N}-])",
    # A book's number (ISBN-13) has 13 digits from 978 or 979 on, with which no card begins.
    "card": r"(?<![\p{L}\p{N}])(?!97[89](?:[ -]?\d){10}(?![ -]?\p{N}))\d(?:[ -]?\d){12,18}(?!\p{N})",
    "person": rf"(?<![\p{{L}}\p{{N}}]){_TITLE}\.? {_NAME}(?: {_NAME})?(?![\p{{L}}\p{{N}}])",
}
ANY = "|".join(f"(?:{pattern})" for pattern in PATTERNS.values())
# What every mention has at least; cheap to look for.
_HINT = rf"[0-9@]|AKIA|(?:sk-|gh[pousr]_|github_pat_|xox)|eyJ|{_PEM}|{_PASSWORD}{_ASSIGN}|(?<!\p{{L}}){_TITLE}\.? \p{{Lu}}"


def cut_at_mentions(text: Column) -> Column:
    """The pieces of a text in order: what stands between mentions, and every second one a mention.

    NULL for a text without a mention. The text is searched once; its mentions are set apart by a mark
    made of the text's own digest, which no text holds.
    """
    mark = F.concat(F.lit("\x1f"), F.sha2(text, 256), F.lit("\x1f"))
    pieces = F.split(F.regexp_replace(text, F.lit(ANY), F.concat(mark, F.lit("$0"), mark)), mark, -1)
    return F.when(text.rlike(_HINT), pieces)


# -------------------------------------------------------------------------------------- units


def _kind(mention: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        kind = F.when(mention.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    # Patterns look at what stands around; a mention alone can only lose by that, never change kind.
    return F.when(mention.rlike(f"^{_PEM}"), F.lit("secret")).otherwise(F.coalesce(kind, F.lit("card")))


def _gender(mention: Column) -> Column:
    gender = F.lit("n")
    for name in ("m", "f"):
        gender = F.when(mention.rlike("^(?:" + "|".join(TITLES[name]) + r")\.? "), F.lit(name)).otherwise(gender)
    return gender


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))


def _units(mention: Column, kind: Column) -> Column:
    """The units of a mention in order, as structs of kind and normal form."""

    def unit(name, value: Column) -> Column:
        return F.struct((name if isinstance(name, Column) else F.lit(name)).alias("unit"), value.alias("value"))

    names = F.split(F.regexp_replace(mention, rf"^{_TITLE}\.? ", ""), " ")
    given = F.concat(F.lit("given-"), _script(mention))
    surname = F.concat(F.lit("surname-"), _script(mention))
    person = F.when(
        F.size(names) > 1,
        F.array(unit(given, F.lower(names[0])), unit(surname, F.lower(names[1]))),
    ).otherwise(F.array(unit(surname, F.lower(names[0]))))
    digits = F.regexp_replace(mention, r"\P{Nd}", "")
    secret = F.regexp_replace(mention, f"^{_LEAD}", "")
    return (
        F.when(kind == "person", person)
        .when(kind.isin("phone", "card", "ssn"), F.array(unit(kind, digits)))
        .when(kind == "iban", F.array(unit(kind, F.replace(mention, F.lit(" "), F.lit("")))))
        .when((kind == "secret") & ~secret.rlike(r"[\p{L}\p{Nd}]"), F.array().cast("array<struct<unit: string, value: string>>"))
        .when(kind == "secret", F.array(unit(kind, F.when(_is_hex(secret), F.lower(secret)).otherwise(secret))))
        .otherwise(F.array(unit(kind, F.lower(mention))))
    )


def _is_hex(text: Column) -> Column:
    return text.rlike("^[0-9a-fA-F]{32,}$")


# --------------------------------------------------------------------------------- surrogates


def _stream(key: str, unit: Column, value: Column, draw: Column) -> Column:
    """Hexadecimal digits drawn from the key, two for each character of the value and more."""
    blocks = F.sequence(F.lit(0), F.floor(F.char_length(value) / 64).cast("int"))
    seed = F.concat_ws("\x1f", F.lit(key), unit, draw.cast("string"), value)
    return F.concat_ws("", F.transform(blocks, lambda b: F.sha2(F.concat(seed, F.lit("\x1f"), b.cast("string")), 512)))


def _number(stream: Column, place) -> Column:
    """The number from 0 to 65535 of four digits that begin at twice ``place``."""
    at = (place if isinstance(place, Column) else F.lit(place)) * 2 + 1
    return F.conv(F.substr(stream, at, F.lit(4)), 16, 10).cast("int")


def _pick(letters: str, number: Column) -> Column:
    return F.substr(F.lit(letters), number % len(letters) + 1, F.lit(1))


_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _like(value: Column, stream: Column, fixed: int | Column = 0, hexadecimal: bool = False) -> Column:
    """Characters of the same classes; the first ``fixed`` ones are kept."""

    def drawn(c: Column, i: Column) -> Column:
        number = _number(stream, i)
        if hexadecimal:
            return _pick("0123456789abcdef", number)
        letter = F.when(c.rlike(r"^\p{Lu}$"), _pick(_UPPER, number)).when(c.rlike(r"^\p{L}$"), _pick(_LOWER, number))
        return F.when(i < fixed, c).when(c.rlike(r"^\p{Nd}$"), _pick("0123456789", number)).otherwise(
            F.coalesce(letter, c)
        )

    return F.concat_ws("", F.transform(F.split(value, ""), drawn))


def _name(syllables: list[str], stream: Column, count: Column) -> Column:
    table = F.array(*map(F.lit, syllables))
    parts = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.get(table, _number(stream, i) % len(syllables)))
    return F.concat_ws("", parts)


def _digit(stream: Column):
    return lambda i: _pick("0123456789", _number(stream, i % 48 + 5))


def _surrogate(key: str) -> Column:
    """The surrogate of a unit in its ``draw``, in lower case where case is the mention's."""
    unit, value, draw = F.col("unit"), F.col("value"), F.col("draw")
    stream = _stream(key, unit, value, draw)
    local = _like(F.substring_index(value, "@", 1), stream)
    # A later draw has another digit, so that there is always room for a distinct address.
    digits = F.transform(F.sequence(F.lit(0), draw), _digit(stream))
    domain = F.concat(F.lit("@mail"), F.concat_ws("", digits), F.lit(".example."))
    email = F.concat(local, domain, F.get(F.array(F.lit("com"), F.lit("net"), F.lit("org")), _number(stream, 7) % 3))
    octets = [(_number(stream, 4 + 2 * k) % 256).cast("string") for k in range(3)]
    ip = F.concat_ws(".", (_number(stream, 0) % 15 + 240).cast("string"), *octets)
    # Six groups of the network that is set aside for examples.
    ip6 = F.concat_ws(":", F.lit("2001:db8"), *[F.substr(stream, F.lit(4 * k + 9), F.lit(4)) for k in range(6)])
    prefix = F.regexp_extract(value, rf"^({'|'.join(_TOKENS)})$", 0)
    public = F.when(prefix != "", F.char_length(F.regexp_extract(value, _PREFIX, 0))).otherwise(0)
    result = (
        F.when(unit == "email", email)
        .when(unit == "ip", ip)
        .when(unit == "ip6", ip6)
        # Later draws of a short number change its first digit too, as there are few others.
        .when(unit == "phone", _like(value, stream, F.when(draw < 4, 1).otherwise(0)))
        .when(unit == "ssn", F.concat(F.lit("9"), F.substr(_like(value, stream), F.lit(2))))
        .when(unit == "iban", _like(value, stream, 2))
        .when((unit == "secret") & _is_hex(value), _like(value, stream, hexadecimal=True))
        .when(unit == "secret", _like(value, stream, public))
        .when(unit == "card", _like(value, stream, 1))
    )
    # Values of few characters can all be taken; from here on each draw has ten times the room.
    more = F.concat_ws("", F.transform(F.sequence(F.lit(_GROWS_AT), draw), _digit(stream)))
    grown = F.when(unit == "ip", F.concat(F.lit("."), more)).otherwise(more)
    result = F.when((draw >= _GROWS_AT) & ~unit.isin("email", "ip6"), F.concat(result, grown)).otherwise(result)
    for script, syllables in _SYLLABLES.items():
        # A later draw has another syllable, so that there is always room for a distinct name.
        surname = _name(syllables, stream, draw + 3)
        result = F.when(unit == f"surname-{script}", surname).otherwise(result)
        for gender in "fmn":
            names = GIVEN_NAMES[gender if script == "latin" else f"{gender}-{script}"]
            listed = F.get(F.array(*map(F.lit, names)), _number(stream, 20) % len(names))
            built = F.when(draw == 0, listed).otherwise(F.concat(listed, F.lit("-"), F.initcap(_name(syllables, stream, draw + 1))))
            result = F.when(unit == f"given-{gender}-{script}", F.lower(built)).otherwise(result)
    return result


def _space(unit: Column) -> Column:
    """Units of one space must differ: given names of any gender are in the same."""
    return F.regexp_replace(unit, "^given-[fmn]-", "given-")


def _taken(drawn: DataFrame, units: DataFrame) -> DataFrame:
    """Units that must draw again: their surrogate is a unit, or another unit holds it."""
    drawn = drawn.withColumn("space", _space(F.col("unit")))
    shared = drawn.groupBy("space", "surrogate").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # The holder of a surrogate is the unit with fewest draws, then the least value.
    claims = drawn.join(shared, ["space", "surrogate"])
    holder = claims.groupBy("space", "surrogate").agg(F.min(F.struct("draw", "value")).alias("holder"))
    lost = claims.join(holder, ["space", "surrogate"]).where(F.col("holder.value") != F.col("value"))
    real = units.select(_space(F.col("unit")).alias("space"), F.col("value").alias("surrogate"))
    real = drawn.join(real, ["space", "surrogate"], "left_semi")
    columns = ["unit", "value", "draw"]
    return lost.select(*columns).unionByName(real.select(*columns)).distinct()


def assign_surrogates(units: DataFrame, key: str) -> DataFrame:
    """``unit, value, surrogate`` for distinct units, with distinct surrogates that are no unit."""
    drawn = staged(units.withColumn("draw", F.lit(0)).withColumn("surrogate", _surrogate(key)), "surrogates")
    for _ in range(_MAX_DRAWS):
        again = staged(_taken(drawn, units), "surrogates")
        if again.isEmpty():
            return drawn.drop("draw")
        settled = drawn.join(again.select("unit", "value"), ["unit", "value"], "left_anti")
        redrawn = again.withColumn("draw", F.col("draw") + 1).withColumn("surrogate", _surrogate(key))
        drawn = staged(settled.unionByName(redrawn.select(*settled.columns)), "surrogates")
    raise RuntimeError(f"no distinct surrogates after {_MAX_DRAWS} draws")


# ------------------------------------------------------------------------------------ mentions


def _refill(mention: Column, characters: Column, inside: str) -> Column:
    """The mention with its characters that match ``inside`` replaced in order, separators kept."""
    letters = F.split(mention, "")

    def put(c: Column, i: Column) -> Column:
        before = F.char_length(F.regexp_replace(F.substr(mention, F.lit(1), i), f"[^{inside}]", ""))
        return F.when(c.rlike(f"^[{inside}]$"), F.substr(characters, before + 1, F.lit(1))).otherwise(c)

    # Characters beyond the mention's own come last.
    own = F.char_length(F.regexp_replace(mention, f"[^{inside}]", ""))
    return F.concat(F.concat_ws("", F.transform(letters, put)), F.substr(characters, own + 1))


def _cased(mention: Column, text: Column) -> Column:
    """``text`` in upper case if all letters of the mention are."""
    return F.when(F.upper(mention) == mention, F.upper(text)).otherwise(text)


def _replacement() -> Column:
    mention, kind, found = F.col("mention"), F.col("kind"), F.col("found")
    only = F.get(found, F.lit(0))
    title = F.regexp_extract(mention, rf"^{_TITLE}\.? ", 0)
    rest = F.substr(mention, F.char_length(title) + 1)
    lead = F.regexp_extract(mention, f"^{_LEAD}", 0)
    secret = F.substr(mention, F.char_length(lead) + 1)

    def capitals(name: Column) -> Column:
        return F.replace(F.initcap(F.replace(name, F.lit("-"), F.lit("- "))), F.lit("- "), F.lit("-"))

    names = F.array_join(F.transform(found, capitals), " ")
    return (
        F.when(kind == "person", F.concat(title, _cased(rest, names)))
        .when(kind.isin("phone", "card", "ssn"), _refill(mention, only, r"\p{Nd}"))
        .when(kind == "iban", _refill(mention, only, "A-Z0-9"))
        .when((kind == "secret") & (F.size(found) == 0), mention)
        .when(kind == "secret", F.concat(lead, F.when(_is_hex(secret), _cased(secret, only)).otherwise(only)))
        .otherwise(_cased(mention, only))
    )


def _replacements(mentions: DataFrame, key: str) -> DataFrame:
    """``mention, replacement`` for the distinct strings in ``mentions``."""
    mention = F.col("mention")
    kinds = mentions.select("mention").distinct().withColumn("kind", _kind(mention))
    # The outer form: a mention without a unit is replaced by itself.
    unit = F.posexplode_outer(_units(mention, F.col("kind"))).alias("place", "u")
    parts = staged(
        kinds.select("mention", "kind", _gender(mention).alias("title"), unit).select(
            "mention", "kind", "place", "u.unit", "u.value", F.when(F.col("u.unit").startswith("given-"), F.col("title")).alias("title")
        ),
        "pii-units",
    )
    told = F.when(F.col("title") != "n", F.col("title"))
    gender = F.when(F.min(told) == F.max(told), F.min(told)).otherwise("n")
    units = parts.where("unit IS NOT NULL").groupBy("unit", "value").agg(gender.alias("gender"))
    gendered = F.when(F.col("unit").startswith("given-"), F.concat(F.lit("given-"), "gender", F.substr("unit", F.lit(6))))
    units = staged(units.select(F.coalesce(gendered, "unit").alias("unit"), "value"), "pii-distinct")
    surrogates = assign_surrogates(units, key).withColumn("unit", _space(F.col("unit")))
    joined = parts.join(surrogates, ["unit", "value"], "left").groupBy("mention", "kind").agg(
        F.sort_array(F.collect_list(F.when(F.col("surrogate").isNotNull(), F.struct("place", "surrogate")))).alias("placed")
    )
    found = joined.withColumn("found", F.transform("placed", lambda x: x["surrogate"]))
    return staged(found.select("mention", _replacement().alias("replacement")), "pii-replacements")


def replace_pii(docs: DataFrame, key: str, count: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text``. ``count`` names a column for the number of mentions."""
    names = docs.columns
    at = names.index("text")
    own = [F.col(f"`{name}`").alias(f"c{i}") for i, name in enumerate(names)]
    text = F.col(f"c{at}")
    cut = docs.select(*own).withColumn("pieces", cut_at_mentions(text))
    # A text without a mention is one piece. One with mentions is kept as its pieces only.
    cut = cut.withColumn("pieces", F.when(F.size("pieces") > 1, F.col("pieces")))
    cut = cut.select("*", F.xxhash64("pieces").alias("k1"), F.xxhash64(F.lit(1), "pieces").alias("k2"))
    cut = staged(cut.withColumn(f"c{at}", F.when(F.col("pieces").isNull(), text)), "pii-pieces")
    with_mention = cut.where("pieces IS NOT NULL")
    mentions = F.filter("pieces", lambda _, i: i % 2 == 1)
    placed = staged(
        with_mention.select("k1", "k2", F.posexplode(mentions).alias("place", "mention")).distinct(), "pii-places"
    )
    table = _replacements(placed, key)
    per_text = staged(
        placed.join(table, "mention")
        .groupBy("k1", "k2")
        .agg(F.sort_array(F.collect_list(F.struct("place", "replacement"))).alias("swap")),
        "pii-texts",
    )
    swapped = F.transform(
        "pieces",
        lambda piece, i: F.when(i % 2 == 0, piece).otherwise(F.get(F.col("swap"), (i / 2).cast("int"))["replacement"]),
    )
    plain = [f"c{i}" for i in range(len(names))]
    changed = with_mention.join(per_text, ["k1", "k2"]).withColumn(f"c{at}", F.concat_ws("", swapped))
    counted = [F.size("swap").cast("long").alias("n")] if count else []
    none = [F.lit(0).cast("long").alias("n")] if count else []
    same = cut.where("pieces IS NULL").select(*plain, *none)
    return same.unionByName(changed.select(*plain, *counted)).toDF(*names, *([count] if count else []))

"""Personal data replaced by keyed surrogates of the same type and format."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climagrid.sources.scratch import materialize

_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_HEX = "[0-9A-Fa-f]{1,4}"

#: Labels of secrets, in any case.
_LABEL = (
    "(?i:token|secret|password|passwd|pwd|api[_ -]?key|access[_ -]?key|secret[_ -]?key|private[_ -]?key"
    "|client[_ -]?secret|bearer)"
)
#: How widely used keys begin that need no label.
_KEY_PREFIX = "(?:AKIA|ASIA|AIza|gh[opsu]_|github_pat_|glpat-|xox[abprs]-|sk-|pk_live_|sk_live_|eyJ)"
#: Country codes of one and two digits; the others have three.
_COUNTRY = "(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"

#: Forms of address by the gender they tell, "n" for none.
ADDRESS = {
    "m": ["Mr", "Sir", "Herr", "Señor", "Sr", "Don", "Monsieur", "господин", "г-н", "κύριος"],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Señora", "Señorita", "Sra", "Doña", "Madame", "Mme", "Mlle", "Dra"]
    + ["госпожа", "г-жа", "κυρία"],
    "n": ["Dr", "Prof", "Doctor", "Professor", "Doktor", "Docteur", "доктор", "д-р", "профессор", "проф", "Δρ", "Καθ"],
}
#: What may stand between the parts of a name and is kept.
_PARTICLE = "(?:van|von|der|den|de|del|della|la|le|di|da|dos|du|bin|ibn|al|el|y)"
#: Given names by gender and script.
GIVEN = {
    ("m", "latin"): "Adam Boris Carl David Emil Felix Hugo Ivan Jonas Karl Leo Marco Oscar Paul".split(),
    ("f", "latin"): "Ada Berta Clara Dora Emma Flora Greta Ida Julia Karla Lena Mara Olga Paula".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Лев Марк Олег Павел Роман".split(),
    ("f", "cyrillic"): "Анна Вера Дарья Ева Зоя Инна Лидия Мария Нина Ольга Раиса Софья".split(),
    ("n", "latin"): "Alex Andrea Charlie Dominique Jamie Jules Kim Luca Noa Robin Sam Sascha Toni".split(),
    ("n", "cyrillic"): "Валя Женя Саша Шура Слава Паша".split(),
    ("n", "greek"): "Αντρέα Άρη Νίκη Φώτη".split(),
    ("m", "greek"): "Αλέξης Γιώργος Δημήτρης Ηλίας Κώστας Μάριος Νίκος Πέτρος Στέφανος".split(),
    ("f", "greek"): "Αθηνά Βασιλική Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Σοφία Χριστίνα".split(),
}
_SYLLABLES = {
    "latin": "ba be bo da de do fa fe fo ga ge go ka ke ko la le lo ma me mo na ne no ra re ro".split(),
    "cyrillic": "ба бе бо да де до за зе зо ка ке ко ла ле ло ма ме мо на не но ра ре ро".split(),
    "greek": "βα βε βο γα γε γο δα δε δο κα κε κο λα λε λο μα με μο να νε νο ρα ρε ρο".split(),
}

#: Endings of drawn given names.
_ENDINGS = {
    "m": {"latin": "n", "cyrillic": "н", "greek": "ς"},
    "f": {"latin": "na", "cyrillic": "на", "greek": "να"},
    "n": {"latin": "i", "cyrillic": "и", "greek": "ι"},
}

_FORMS = sorted({b for names in ADDRESS.values() for a in names for b in (a, a.upper())}, key=lambda a: (-len(a), a))
_ADDRESS = "(?:" + "|".join(_FORMS) + ")"
_WORD = r"\p{Lu}[\p{L}\p{M}]*+(?:['’-]\p{L}[\p{L}\p{M}]++)*+"
_INITIALS = r"(?:\p{Lu}\. ?){0,3}"
_PART = rf"(?:{_PARTICLE} ){{0,2}}{_INITIALS}{_WORD}"
_NAME = f"{_PART}(?: {_PART}){{0,3}}"

_PHONES = [
    r"(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{2,4}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}",
    # International, 8 to 15 digits in any grouping.
    r"(?:\+|00(?=[1-9]))(?=(?:[ ().-]{0,2}[0-9]){8,15}(?![0-9]))[0-9]{1,3}(?:[ .-]?(?:\([0-9]{1,5}\)|[0-9]{1,14})){1,6}",
    # National: pairs after a zero; an area after a zero; threes, or three and pairs; ten digits unbroken.
    "0[0-9](?:[ .-][0-9]{2}){4}",
    "\\(?0[1-9][0-9]{1,3}\\)?[ /-][0-9]{3,8}(?:[ -][0-9]{2,5}){0,2}",
    "[6-9][0-9]{2}(?: [0-9]{3} [0-9]{3}|(?: [0-9]{2}){3})",
    "1?[2-9][0-9]{2}[2-9][0-9]{6}",
    "0[1-9][0-9]{8,9}",
]

#: What is found without the context of its document, first kinds first.
PATTERNS = {
    "email": r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]{1,64}+@[\p{L}\p{M}\p{N}-]{1,63}(?:\.[\p{L}\p{M}\p{N}-]{1,63}){1,8}",
    "secret": rf"(?<![A-Za-z0-9]){_LABEL}\s{{0,3}}[=:]\s{{0,3}}[\"']?(?=[_+/-]{{0,127}}[A-Za-z0-9])[A-Za-z0-9_+/-]{{16,128}}",
    # Keys without a label: a known beginning, or small letters, capitals and digits mixed.
    "key": rf"(?<![A-Za-z0-9_+/=.-])(?:{_KEY_PREFIX}(?=[A-Za-z_.-]*[0-9])[A-Za-z0-9_.-]{{16,200}}"
    r"|(?=[A-Z0-9]*[a-z])(?=[a-z0-9]*[A-Z])(?=[A-Za-z]*[0-9])(?=[A-Za-z]*[0-9]+[A-Za-z]+[0-9])[A-Za-z0-9]{24,200})(?![A-Za-z0-9_])",
    "ip": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])"
    rf"|(?<![0-9A-Za-z:.])(?:{_HEX}(?::{_HEX}){{7}}|(?=[0-9A-Fa-f]{{0,3}}[0-9])[0-9A-Fa-f]{{3,4}}(?::{_HEX}){{0,6}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![0-9A-Za-z:])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}(?: [0-9]{4}){3}|[0-9]{4}(?:-[0-9]{4}){3}"
    r"|3[47][0-9]{2}(?: [0-9]{6} |-[0-9]{6}-)[0-9]{5})(?![0-9])",
    "phone": rf"(?<![0-9A-Za-z.])(?:{'|'.join(_PHONES)})(?![0-9])",
}
_ALONE = "|".join(PATTERNS.values())
#: A name after forms of address, which stay.
TITLED = rf"(?<![\p{{L}}])(?:{_ADDRESS}\.? ){{1,3}}{_NAME}"
ANY = f"{_ALONE}|{TITLED}"
#: What is found in a document that names somebody: capitalised words too, some of which are the name.
_WITH_WORDS = rf"{_ALONE}|(?<![\p{{L}}\p{{N}}]){_WORD}(?![\p{{L}}])"
#: What any text with a mention holds: the other patterns are tried on such texts alone.
_GATE = (
    rf"[0-9@=:]|(?=[{''.join(sorted({a[0] for a in _FORMS}))}])(?<![\p{{L}}]){_ADDRESS}\.? (?:{_PARTICLE} |\p{{Lu}})"
)

#: Blocks of keyed hash for each draw: two hexadecimal digits a character.
_BLOCKS = 6
#: Draws after which an IP address of version 4 gets one of version 6, whose space is never full.
_WIDER_IP = 16


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _chars(text: Column) -> Column:
    return F.when(F.length(text) > 0, F.sequence(F.lit(1), F.length(text))).otherwise(
        F.array().cast("array<int>")
    )


def _at(text: Column, i: Column | int) -> Column:
    return F.substring(text, i, 1)


def _byte(stream: Column, i: Column | int) -> Column:
    """The i-th number from 0 to 255 of a hexadecimal stream, counted from 1, in rounds."""
    rounds = (F.lit(i) - 1) % (32 * _BLOCKS)
    return F.conv(F.substring(stream, (rounds * 2 + 1).cast("int"), F.lit(2)), 16, 10).cast("int")


def _of(items: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(i) for i in items]), (number % len(items) + 1).cast("int"))


def _alike(text: Column, stream: Column, letters: int | Column = 26) -> Column:
    """Characters of the same kind: digits, small letters and capitals of the same script; others as
    they are. Letters of scripts that are not drawn from become Latin ones."""

    def one(i: Column) -> Column:
        char, drawn = _at(text, i), _byte(stream, i)
        return (
            F.when(char.rlike("[0-9]"), (drawn % 10).cast("string"))
            .when(char.rlike("[a-z]"), F.chr(97 + drawn % letters))
            .when(char.rlike("[A-Z]"), F.chr(65 + drawn % letters))
            .when(char.rlike(r"\p{IsCyrillic}"), _of(list("абвгдежзиклмнопрстуфхцчшщэюя"), drawn))
            .when(char.rlike(r"\p{IsGreek}"), _of(list("αβγδεζηθικλμνξοπρστυφχψω"), drawn))
            .when(char.rlike(r"\p{L}"), F.chr(97 + drawn % letters))
            .otherwise(char)
        )

    return F.array_join(F.transform(_chars(text), one), "")


def _wider(text: Column, attempt: Column) -> Column:
    """The value to draw one like: longer after every other collision, so that no space is full.

    A value without letters or digits, of which there is no other, gives way to letters.
    """
    pad = F.when(text.rlike("^[0-9]+$"), "0").when(text.rlike("[A-Z]") & ~text.rlike("[a-z]"), "A").otherwise("a")
    base = F.when(text.rlike("[A-Za-z0-9]"), text).otherwise(F.lit("aaaaaaaa"))
    return F.concat(base, F.repeat(pad, F.floor(attempt / 2).cast("int")))


def _check_digit(body: Column) -> Column:
    """What makes the digits before it pass the check of card numbers."""

    def weighed(i: Column) -> Column:
        digit = _at(body, F.length(body) - i + 1).cast("int")
        double = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return F.when(i % 2 == 1, double).otherwise(digit)

    total = F.aggregate(F.transform(_chars(body), weighed), F.lit(0), lambda a, b: a + b)
    return ((10 - total % 10) % 10).cast("string")


def _national(raw: Column) -> Column:
    """A phone number's digits without country code and leading zeros: the same however it is written."""
    number = _digits(raw)
    abroad = raw.rlike(r"^(?:\+|00)")
    bare = F.regexp_replace(number, rf"^(?:00)?{_COUNTRY}0*", "")
    home = F.when((F.length(number) == 11) & number.startswith("1"), F.substring(number, 2, 10))
    found = F.when(abroad, bare).otherwise(F.coalesce(home, F.regexp_replace(number, "^0+", "")))
    return F.when(F.length(found) > 0, found).otherwise(number)


def _mentions(raw: DataFrame) -> DataFrame:
    """Adds ``kind``, ``entity`` (what mentions of one entity share) and ``prefix`` to ``raw, named``.

    ``named`` marks parts of names. A digit string that fails the check of card numbers is no entity, as
    is a capitalised word that names nobody: its kind is null.
    """
    text, kind = F.col("raw"), F.lit(None).cast("string")
    for name in reversed(PATTERNS):
        kind = F.when(text.rlike(f"^(?:{PATTERNS[name]})$"), name).otherwise(kind)
    named = raw.withColumn("kind", F.when(F.col("named"), "name").otherwise(kind))
    card = (F.col("kind") == "card") & ~F.call_function("luhn_check", _digits(text))
    named = named.withColumn("kind", F.when(~card | F.col("kind").isNull(), F.col("kind")))
    label = F.regexp_extract(text, rf"^{_LABEL}\s*[=:]\s*[\"']?", 0)
    prefix = F.when(F.col("kind") == "secret", label).when(
        F.col("kind") == "key", F.regexp_extract(text, f"^{_KEY_PREFIX}", 0)
    )
    named = named.withColumn("prefix", F.coalesce(prefix, F.lit("")))
    rest = F.substring(text, F.length("prefix") + 1, F.length(text))
    entity = (
        F.when(F.col("kind").isin("email", "name"), F.lower(text))
        .when(F.col("kind") == "card", _digits(text))
        .when(F.col("kind") == "phone", _national(text))
        .when(F.col("kind") == "ip", F.lower(text))
        .otherwise(rest)
    )
    return named.withColumn("entity", entity)


def _parts(titled: Column) -> Column:
    """The parts of a name after its forms of address, without particles and initials."""
    words = F.split(F.regexp_replace(titled, rf"^(?:{_ADDRESS}\.? )+", ""), "[ .]+")
    return F.filter(words, lambda w: w.rlike(r"^\p{Lu}") & (F.length(w) > 1))


def _styles(titled: DataFrame) -> DataFrame:
    """``entity, style`` of every part of a name: ``m``, ``f`` or ``n`` for a given name by the gender
    that its forms of address tell, ``family`` for one that is nowhere a given name."""
    forms = F.upper(F.regexp_replace(F.regexp_extract("titled", rf"^(?:{_ADDRESS}\.? )+", 0), r"[.]", ""))
    told = F.lit("n")
    for gender in ("m", "f"):
        told = F.when(F.arrays_overlap(F.split(forms, " "), F.array(*[F.lit(a.upper()) for a in ADDRESS[gender]])), gender).otherwise(told)
    parts = titled.select(told.alias("gender"), _parts(F.col("titled")).alias("parts"))
    parts = parts.select("gender", F.size("parts").alias("n"), F.posexplode("parts").alias("i", "part"))
    given = F.when(F.col("i") < F.col("n") - 1, F.col("gender"))
    sure = F.min(F.when(given != "n", given))
    return parts.groupBy(F.lower("part").alias("entity")).agg(
        F.coalesce(sure, F.min(given), F.lit("family")).alias("style")
    )


def _stream(key: str) -> Column:
    """Hexadecimal digits drawn from key, kind, entity and attempt."""
    drawn = ["kind", "entity", F.col("attempt").cast("string")]
    return F.concat(
        *[F.sha2(F.concat_ws("\1", F.lit(key), *drawn, F.lit(b)), 256) for b in range(_BLOCKS)]
    )


def _surrogate() -> Column:
    """The replacement of ``kind, entity`` by ``stream`` and ``attempt``."""
    kind, entity, attempt, stream, style = map(F.col, ("kind", "entity", "attempt", "stream", "style"))
    local, domain = F.substring_index(entity, "@", 1), F.substring_index(entity, "@", -1)
    host = F.substring_index(domain, ".", 1)
    email = F.concat(
        _alike(_wider(local, attempt), stream), F.lit("@"), _alike(host, F.reverse(stream)), F.lit(".example.org")
    )
    octets = [(_byte(stream, 1) % 223 + 1).cast("string")]
    octets += [_byte(stream, i).cast("string") for i in (2, 3, 4)]
    blocks = [F.substring(stream, i, 4) for i in range(1, 25, 4)]
    ip = F.when((attempt < _WIDER_IP) & ~F.contains(entity, F.lit(":")), F.concat_ws(".", *octets)).otherwise(
        F.concat_ws(":", F.lit("2001:db8"), *blocks)
    )
    first, digits = (_byte(stream, 1) % 8 + 2).cast("string"), _wider(entity, attempt)
    phone = F.concat(first, F.substring(_alike(digits, stream), F.lit(2), F.length(digits)))
    body = F.concat(
        _at(entity, 1), F.substring(_alike(digits, stream), F.lit(2), F.length(digits) - 2)
    )
    card = F.concat(body, _check_digit(body))
    letters = F.when(entity.rlike("^[0-9a-f]+$|^[0-9A-F]+$"), 6).otherwise(26)
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", ip)
        .when(kind == "phone", phone)
        .when(kind == "card", card)
        .when(kind == "name", _person(entity, style, stream, attempt))
        .otherwise(_alike(_wider(entity, attempt), stream, letters))
    )


def _person(entity: Column, style: Column, stream: Column, attempt: Column) -> Column:
    """A part of a name of the same style and script; a common given name first, then drawn ones that
    get longer after repeated collisions."""
    script = F.when(entity.rlike(r"\p{IsCyrillic}"), "cyrillic").when(entity.rlike(r"\p{IsGreek}"), "greek")
    script, part = F.coalesce(script, F.lit("latin")), F.lit(None).cast("string")
    places = F.sequence(F.lit(2), (F.lit(5) + attempt / 4).cast("int"))
    for s, syllables in _SYLLABLES.items():
        drawn = F.array_join(F.transform(places, lambda i: _of(syllables, _byte(stream, i))), "")  # noqa: B023
        part = F.when((script == s) & (style == "family"), drawn).otherwise(part)
        for g, endings in _ENDINGS.items():
            longer = F.concat(F.substring(drawn, F.lit(1), F.length(drawn) - 2), F.lit(endings[s]))
            given = F.when(attempt < 2, F.lower(_of(GIVEN[g, s], _byte(stream, 1)))).otherwise(longer)
            part = F.when((script == s) & (style == g), given).otherwise(part)
    return part


def _written(raw: Column, kind: Column, prefix: Column, entity: Column, new: Column) -> Column:
    """The surrogate in the format of the mention: its punctuation, country code and case.

    Digits that it has beyond the entity's follow at the end.
    """
    number = _digits(raw)
    given = F.length(number) - F.length(entity)

    def fill(i: Column) -> Column:
        place = F.length(_digits(F.substring(raw, F.lit(1), i)))
        return F.when(_at(raw, i).rlike("[0-9]") & (place > given), _at(new, place - given)).otherwise(_at(raw, i))

    rest = F.substring(new, F.length(entity) + 1, F.length(new))
    filled = F.concat(F.array_join(F.transform(_chars(raw), fill), ""), rest)
    shouted = (F.upper(raw) == raw) & (F.lower(raw) != raw)
    name = F.concat(F.upper(_at(new, 1)), F.substring(new, F.lit(2), F.length(new)))
    return (
        F.when(kind.isin("phone", "card"), filled)
        .when(kind == "email", F.when(shouted, F.upper(new)).otherwise(new))
        .when(kind == "name", F.when(shouted & (F.length(raw) > 1), F.upper(new)).otherwise(name))
        .otherwise(F.concat(prefix, new))
    )


def assign_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind, entity, new`` for distinct ``kind, entity``: distinct surrogates that are no entity.

    Names may have a ``style``, family names by default (see ``_styles``).
    All draws are compared by joins and grouped aggregates over the entities alone. Of equal draws
    the one of fewer attempts stays, then the smaller entity; the others, and draws that are
    themselves an entity of the corpus, are drawn anew until none is left. What is drawn from
    widens with the attempts for every kind, so that this ends however many entities there are.
    """
    style = F.col("style") if "style" in entities.columns else F.lit("family")
    drawn = entities.select("kind", "entity", style.alias("style"), F.lit(0).alias("attempt"))
    known = materialize(entities.select(F.col("kind").alias("k"), F.col("entity").alias("e")), "known")
    while True:
        drawn = drawn.withColumn("stream", _stream(key)).withColumn("new", _surrogate())
        drawn = materialize(drawn.drop("stream"), "drawn")
        firsts = drawn.groupBy("kind", "new").agg(
            F.min(F.struct("attempt", "entity")).alias("first"), F.count("*").alias("n")
        )
        firsts = firsts.where("n > 1").select(
            F.col("kind").alias("k"), F.col("new").alias("e"), F.col("first.entity").alias("winner")
        )
        losers = drawn.join(firsts, (F.col("kind") == F.col("k")) & (F.col("new") == F.col("e")))
        losers = losers.where("entity <> winner").select("kind", "entity")
        real = drawn.join(known, (F.col("kind") == F.col("k")) & (F.col("new") == F.col("e")), "left_semi")
        again = losers.union(real.select("kind", "entity")).distinct().withColumn("more", F.lit(1))
        again = materialize(again, "drawn-again")
        if again.isEmpty():
            return drawn.select("kind", "entity", "new")
        drawn = drawn.drop("new").join(again, ["kind", "entity"], "left").select(
            "kind", "entity", "style", (F.col("attempt") + F.coalesce("more", F.lit(0))).alias("attempt")
        )


def _count(hits: Column, between: Column) -> Column:
    """Mentions that were replaced; parts of a name with one blank between them are one mention."""

    def begins(i: Column) -> Column:
        own, last = F.get(hits, i), F.get(hits, i - 1)
        same = own["named"] & F.coalesce(last["hit"] & last["named"], F.lit(False)) & (F.get(between, i) == " ")
        return own["hit"] & ~F.coalesce(same, F.lit(False))

    places = F.when(F.size(hits) > 0, F.sequence(F.lit(0), F.size(hits) - 1)).otherwise(F.array().cast("array<int>"))
    return F.size(F.filter(places, begins)).cast("bigint")


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """Documents with surrogates in place of the personal data in ``text``, and ``n_replaced``.

    Replaced are e-mail addresses, labelled secrets, unlabelled keys of known or mixed form, IP addresses
    of both versions, card numbers (that pass their check), phone numbers (international, in the usual
    national groupings, and ten digits unbroken), and names after a form of address, with further
    mentions of their parts in the same document, with or without the form. Names that no form of
    address introduces in their document are not found, nor names in scripts without capitals.

    One entity has one surrogate throughout; different ones have different ones; none is an entity of
    the corpus. E-mail addresses are one in any case, cards and phone numbers in any grouping and with or
    without their country code. A name's parts have a surrogate each, by gender and script, so that a
    full name, its family name and a title with either stay one person; a part is a given or a family
    name corpus-wide. With the same ``key`` and corpus the result is the same.

    Texts are tried once for what any mention holds; those that do (few, in prose) are kept with their
    mentions, so the patterns run over them once more only to cut them. The distinct mentions and
    entities are worked on apart from the texts; texts meet their replacements by the list of their
    mentions, which adaptive execution splits where copies share a list.

    ``n_replaced`` counts mentions, a name's parts side by side as one, and replaces a column of that
    name; other columns, whatever their names, come through, as do repeated rows and null ids. A null
    text stays null, with none replaced. An empty table gives no rows. A task holds one row at a time,
    with the list of its mentions: a very long text costs its own size a few times.
    """
    kept = [c for c in docs.columns if c != "n_replaced"]
    text = F.col("text").cast("string")
    gate = F.coalesce(text.rlike(_GATE), F.lit(False))
    rows = docs.select(*[F.col(f"`{c}`") if c != "text" else text.alias("text") for c in kept])
    some = rows.where(gate).withColumn("__all", F.regexp_extract_all("text", F.lit(ANY), F.lit(0)))
    some = some.withColumn("__titled", F.filter("__all", lambda m: m.rlike(f"^{TITLED}$")))
    some = some.withColumn("__parts", F.transform(F.flatten(F.transform("__titled", _parts)), F.lower))
    words = F.regexp_extract_all("text", F.lit(_WITH_WORDS), F.lit(0))

    def entry(mention: Column) -> Column:
        named = F.array_contains("__parts", F.lower(mention)) & mention.rlike(f"^{_WORD}$")
        return F.struct(mention.alias("raw"), named.alias("named"))

    found = F.when(F.size("__parts") > 0, F.transform(words, entry)).otherwise(
        F.transform("__all", lambda m: F.struct(m.alias("raw"), F.lit(False).alias("named")))
    )
    some = some.withColumn("__found", found)
    shown = F.transform("__found", lambda f: F.concat(f["raw"], F.when(f["named"], "\2").otherwise("")))
    some = some.withColumn("__list", F.when(F.size("__found") > 0, F.sha2(F.concat_ws("\1", shown), 256)))
    some = materialize(some.drop("__all"), "texts-with-mentions")
    matched = some.where("__list IS NOT NULL")
    none = rows.where(~gate).unionByName(some.where("__list IS NULL").select(*[F.col(f"`{c}`") for c in kept]))

    lists = matched.groupBy("__list").agg(F.first("__found").alias("found"))
    lists = materialize(lists.select(F.col("__list").alias("__mentions"), "found"), "mention-lists")
    raw = lists.select(F.explode("found").alias("f")).select("f.raw", "f.named").distinct()
    mentions = materialize(_mentions(raw), "mentions")
    titled = matched.select(F.explode("__titled").alias("titled")).distinct()
    styles = materialize(_styles(titled).withColumn("kind", F.lit("name")), "styles")
    entities = mentions.where("kind IS NOT NULL").select("kind", "entity").distinct()
    entities = entities.join(styles, ["kind", "entity"], "left").na.fill("family", ["style"])
    surrogates = assign_surrogates(materialize(entities, "entities"), key)
    replaced = mentions.join(surrogates, ["kind", "entity"]).select(
        "raw", "named", _written(*map(F.col, ("raw", "kind", "prefix", "entity", "new"))).alias("new")
    )
    replaced = materialize(replaced, "replacements")
    placed = lists.select("__mentions", F.posexplode("found").alias("pos", "f")).select("__mentions", "pos", "f.*")
    placed = placed.join(replaced, ["raw", "named"], "left")
    place = F.struct("pos", F.coalesce("new", "raw").alias("new"), F.col("new").isNotNull().alias("hit"), "named")
    news = placed.groupBy("__mentions").agg(F.sort_array(F.collect_list(place)).alias("__new"))
    news = materialize(news, "replacement-lists")
    joined = matched.join(news, F.col("__list") == F.col("__mentions"))
    cut = F.when(F.size("__parts") > 0, F.split("text", _WITH_WORDS, -1)).otherwise(F.split("text", ANY, -1))
    joined = joined.withColumn("__between", cut)
    ends = F.concat(F.col("__new.new"), F.array(F.lit("")))
    whole = F.array_join(F.zip_with("__between", ends, lambda a, b: F.concat(a, b)), "")
    columns = [F.col(f"`{c}`") if c != "text" else whole.alias("text") for c in kept]
    counted = joined.select(*columns, _count(F.col("__new"), F.col("__between")).alias("n_replaced"))
    return counted.union(none.select("*", F.lit(0).cast("bigint").alias("n_replaced")))

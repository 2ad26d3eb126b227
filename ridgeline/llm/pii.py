"""Personal data replaced by keyed surrogates, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridgeline.llm.common import fresh
from ridgeline.sources.scratch import staged

TITLES = "Mr|Mrs|Ms|Dr|Sr|Sra|Mme|Herr|Frau|Miss|Señor|Señora"
#: What is looked for, first match first: kind and pattern. Fixed values of formats.
ENTITIES = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]*[\p{L}\p{N}_%+-]@(?:[\p{L}\p{N}-]+\.)+\p{L}{2,}",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)",
    "ipv6": r"(?<![\p{L}\p{N}:])(?:(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}|(?:[0-9a-fA-F]{1,4}:){1,6}(?::[0-9a-fA-F]{1,4}){1,6})(?![\p{L}\p{N}:])",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4})(?!\d)",
    "ssn": r"(?<!\d)\d{3}-\d{2}-\d{4}(?!\d)",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "card": r"(?<!\d)\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,7}(?!\d)",
    "token": r"(?<![\p{L}\p{N}])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![\p{L}\p{N}])",
    "key": r"(?<![\p{L}\p{N}])AKIA[0-9A-Z]{16}(?![\p{L}\p{N}])",
    "name": rf"(?<=(?<!\p{{L}})(?:{TITLES})\.? )\p{{Lu}}\p{{L}}+(?:[ -]\p{{Lu}}\p{{L}}+){{0,2}}",
}
PATTERN = "|".join(f"(?:{p})" for p in ENTITIES.values())
#: Every text that PATTERN matches has one of these, which are found without looking back.
HINT = rf"@|[0-9][ .()-]{{0,2}}[0-9]|[0-9a-fA-F]:[0-9a-fA-F:]|[0-9a-f]{{32}}|[0-9A-F]{{32}}|AKIA|(?:{TITLES})\.? \p{{Lu}}"
#: Signs that no character has; they enclose an entity in a marked text, and the third stands before what stood for them.
OPEN, CLOSE, ESCAPE = "\uFDD0", "\uFDD1", "\uFDD2"
ESCAPED = {ESCAPE: ESCAPE + "\uFDD5", OPEN: ESCAPE + "\uFDD3", CLOSE: ESCAPE + "\uFDD4"}
#: Vowels and consonants that stand in for each other, per script.
SCRIPTS = (
    ("aeiouàâäáãéèêëíìîïóòôöõúùûüåæøœąęėįųūőű", "bcdfghjklmnpqrstvwxyzçñßšžłśćźżńčřďťňğşđģķļņ"),
    ("аеиоуыэюяёіїє", "бвгджзклмнпрстфхцчшщйьъґ"),
    ("αεηιουωάέήίόύώ", "βγδζθκλμνξπρστφχψς"),
)
#: Of these the surrogate's letters are drawn.
DRAWN = (("aeiou", "bdfghklmnprstvz"), ("аеиоу", "бвгджзклмнпрстфх"), ("αεηιο", "βγδζθκλμνξπρστφχ"))
#: Other scripts: first letter of a range, and how many letters it has that can all stand alone.
RANGES = (
    (0x0100, 0x80), (0x0531, 38), (0x0561, 38), (0x05D0, 27), (0x0621, 26), (0x0641, 10), (0x0904, 50), (0x0E01, 46),
    (0x10D0, 33), (0x3041, 86), (0x30A1, 90), (0x4E00, 20902), (0xAC00, 11172),
)
NUMBERS = ("phone", "ssn", "card")
#: Draws after which a surrogate gets a sign more than its entity has, and one more after as many again.
PATIENCE = 4


def _marked(text: Column) -> Column:
    """``text`` with OPEN and CLOSE around every entity."""
    safe = text
    for sign, stand_in in ESCAPED.items():
        safe = F.replace(safe, F.lit(sign), F.lit(stand_in))
    return F.regexp_replace(F.when(text.rlike(f"[{OPEN}-{ESCAPE}]"), safe).otherwise(text), PATTERN, f"{OPEN}$0{CLOSE}")


def _unescaped(text: Column) -> Column:
    for sign, stand_in in reversed(ESCAPED.items()):
        text = F.replace(text, F.lit(stand_in), F.lit(sign))
    return text


def _parts(marked: Column) -> Column:
    """Plain text and entities in turn, plain text first and last."""
    return F.split(marked, f"[{OPEN}{CLOSE}]", -1)


def _by_word(parts: Column) -> Column:
    """Parts with every word of a name as an entity of its own, also where it stands in the text without a title."""
    names = F.filter(parts, lambda p, i: (i % 2 == 1) & (_kind(p) == "name"))
    words = F.array_distinct(F.flatten(F.transform(names, lambda p: F.regexp_extract_all(p, F.lit(r"\p{L}+"), F.lit(0)))))
    anywhere = F.concat(F.lit(r"(?<!\p{L})(?:"), F.array_join(words, "|"), F.lit(r")(?!\p{L})"))
    mark = F.lit(f"{OPEN}$0{CLOSE}")

    def one(p: Column, i: Column) -> Column:
        whole = F.concat(F.lit(OPEN), p, F.lit(CLOSE))
        entity = F.when(_kind(p) == "name", F.regexp_replace(p, F.lit(r"\p{L}+"), mark)).otherwise(whole)
        return F.when(i % 2 == 1, entity).otherwise(F.regexp_replace(p, anywhere, mark))

    return F.when(F.size(words) > 0, _parts(F.array_join(F.transform(parts, one), ""))).otherwise(parts)


def _kind(entity: Column) -> Column:
    out = None
    for kind, pattern in ENTITIES.items():
        if kind == "name":
            break
        whole = entity.rlike(f"^(?:{pattern})$")
        out = F.when(whole, kind) if out is None else out.when(whole, kind)
    return out.otherwise("name")


def _canonical(entity: Column, kind: Column) -> Column:
    """What is the same person or thing in whatever format: case for addresses, separators for numbers."""
    return (
        F.when(kind.isin(*NUMBERS), F.regexp_replace(entity, r"\D", ""))
        .when(kind == "iban", F.replace(entity, F.lit(" "), F.lit("")))
        .when(kind.isin("email", "token", "ipv6"), F.lower(entity))
        .otherwise(entity)
    )


def _pick(letters: str, draw: Column) -> Column:
    return F.substring(F.lit(letters), (F.pmod(draw, F.lit(len(letters))) + 1).cast("int"), F.lit(1))


def _other_letter(c: Column, draw: Column) -> Column:
    """Another letter of the range that ``c`` is in; signs outside all ranges stay."""
    code = F.ascii(c)
    out = None
    for first, size in RANGES:
        # An even step keeps the case in the one range where cases alternate.
        step = 2 * (1 + F.pmod(draw, F.lit(size // 2 - 1))) if first == 0x0100 else 1 + F.pmod(draw, F.lit(size - 1))
        moved = F.lit(first) + F.pmod(code - first + step, F.lit(size))
        letter = F.decode(F.unhex(F.lpad(F.hex(moved.cast("long")), 8, "0")), "UTF-32")
        hit = (code >= first) & (code < first + size)
        out = F.when(hit, letter) if out is None else out.when(hit, letter)
    return out.otherwise(c)


def _changed(text: Column, seed: Column, keep_from: Column, keep_last: Column) -> Column:
    """Every letter and digit by another of its kind, drawn from ``seed`` and its place.

    Digits give digits, vowels vowels, consonants consonants, in their script and
    case. The first ``keep_from`` and the last ``keep_last`` characters, and all
    other signs, stay.
    """
    size = F.length(text)

    def one(c: Column, i: Column) -> Column:
        draw = F.xxhash64(seed, i)
        low = F.lower(c)
        out = F.when((i < keep_from) | (i >= size - keep_last), c).when((c >= "0") & (c <= "9"), _pick("0123456789", draw))
        for known, drawn in zip(SCRIPTS, DRAWN):
            for letters, from_ in zip(known, drawn):
                new = _pick(from_, draw)
                out = out.when(F.instr(F.lit(letters), low) > 0, F.when(c == low, new).otherwise(F.upper(new)))
        return out.otherwise(_other_letter(c, draw))

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _name(word: Column, seed: Column) -> Column:
    """A word that can be spoken: consonants and vowels in turn before the entity's own ending.

    The ending, two letters of a word of four and more, else one, stays: in most
    languages it tells the gender. Case and script are the word's.
    """
    size = F.length(word)
    stay = F.when(size >= 4, 2).when(size >= 2, 1).otherwise(0)
    first = F.lower(F.substring(word, (size - stay + 1).cast("int"), F.lit(1)))
    vowels = F.lit("".join(v for v, _ in SCRIPTS))
    soft = (stay > 0) & (F.instr(vowels, first) > 0)

    def one(c: Column, i: Column) -> Column:
        draw, low = F.xxhash64(seed, i), F.lower(c)
        near = (size - stay - i) % 2 == 1
        vowel = near != soft
        out = F.when(i >= size - stay, c)
        for known, drawn in zip(SCRIPTS, DRAWN):
            new = F.when(vowel, _pick(drawn[0], draw)).otherwise(_pick(drawn[1], draw))
            out = out.when(F.instr(F.lit("".join(known)), low) > 0, F.when(c == low, new).otherwise(F.upper(new)))
        return out.otherwise(_other_letter(c, draw))

    return F.array_join(F.transform(F.split(word, ""), one), "")


def _luhn(digits: Column) -> Column:
    """Sum of the Luhn check over all digits; a valid number has a multiple of ten."""
    places = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        d.cast("int") * 2 - F.when(d.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(places, F.lit(0), lambda a, x: a + x)


def _with_iban_check(iban: Column) -> Column:
    """``iban`` with the check digits that make it 1 modulo 97."""

    def step(acc: Column, c: Column) -> Column:
        letter = F.ascii(c) - 55
        return F.when(c >= "A", (acc * 100 + letter) % 97).otherwise((acc * 10 + F.ascii(c) - 48) % 97)

    moved = F.concat(F.substring(iban, 5, 64), F.substring(iban, 1, 2), F.lit("00"))
    check = F.lit(98) - F.aggregate(F.split(moved, ""), F.lit(0), step)
    return F.concat(F.substring(iban, 1, 2), F.lpad(check.cast("string"), 2, "0"), F.substring(iban, 5, 64))


def _surrogate(kind: Column, canonical: Column, attempt: Column, key: str) -> Column:
    """The stand-in for a canonical entity; another ``attempt`` gives another one.

    After PATIENCE attempts it grows by a letter or digit, and again after as
    many, so that no format can run out of values.
    """

    def seed(*parts: Column) -> Column:
        return F.sha2(F.concat_ws("|", F.lit(key), *parts), 256)

    own = seed(kind, canonical, attempt.cast("string"))
    zero = F.lit(0)
    longer = F.floor(attempt / PATIENCE).cast("int")
    places = F.when(longer > 0, F.sequence(F.lit(1), longer)).otherwise(F.array().cast("array<int>"))
    digits = F.array_join(F.transform(places, lambda n: _pick("0123456789", F.xxhash64(own, F.lit("more"), n))), "")
    letters = F.array_join(F.transform(places, lambda n: _pick("aeioulmnrst", F.xxhash64(own, F.lit("more"), n))), "")
    domain = F.substring_index(canonical, "@", -1)
    top = F.length(F.substring_index(domain, ".", -1)) + 1
    email = F.concat(
        _changed(F.substring_index(canonical, "@", 1), own, zero, zero), letters, F.lit("@"), _changed(domain, seed(F.lit("domain"), domain), zero, top)
    )
    octet = lambda o, i: (F.pmod(F.xxhash64(own, i), F.lit(254)) + 1).cast("string")
    ip = F.array_join(F.transform(F.split(canonical, r"\."), octet), ".")
    nibble = lambda c, i: F.when(c == ":", c).otherwise(_pick("0123456789abcdef", F.xxhash64(own, i)))
    token = F.array_join(F.transform(F.split(canonical, ""), nibble), "")
    sign = lambda c, i: F.when(i < 4, c).otherwise(_pick("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", F.xxhash64(own, i)))
    access_key = F.concat(F.array_join(F.transform(F.split(canonical, ""), sign), ""), digits)
    number = F.concat(_changed(canonical, own, F.lit(1), zero), digits)
    body = F.substring(number, F.lit(1), F.length(number) - 1)
    check = F.pmod(F.lit(10) - F.pmod(_luhn(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10))
    card = F.when(_luhn(canonical) % 10 == 0, F.concat(body, check.cast("string"))).otherwise(number)
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", F.when(longer > 0, F.concat_ws(".", ip, digits)).otherwise(ip))
        .when(kind.isin("token", "ipv6"), F.concat(token, digits))
        .when(kind == "key", access_key)
        .when(kind == "card", card)
        .when(kind == "iban", _with_iban_check(F.concat(_changed(canonical, own, F.lit(2), zero), digits)))
        .when(kind == "name", F.concat(_name(canonical, own), letters))
        .otherwise(number)
    )


def _formatted(entity: Column, kind: Column, surrogate: Column) -> Column:
    """The surrogate in the format of this occurrence: its separators, or its case letter by letter."""
    signs = F.split(entity, "")

    def spaced(is_sign) -> Column:
        def one(acc: Column, c: Column) -> Column:
            put = F.when(is_sign(c), F.substring(surrogate, acc["n"], F.lit(1))).otherwise(c)
            return F.struct((acc["n"] + is_sign(c).cast("int")).alias("n"), F.concat(acc["s"], put).alias("s"))

        start = F.struct(F.lit(1).alias("n"), F.lit("").alias("s"))
        # What the surrogate has more goes to the end.
        return F.aggregate(signs, start, one, lambda acc: F.concat(acc["s"], F.substring(surrogate, acc["n"], F.length(surrogate))))

    def cased(c: Column, i: Column) -> Column:
        old = F.coalesce(F.get(signs, i), F.lit("a"))
        return F.when((old == F.upper(old)) & (old != F.lower(old)), F.upper(c)).otherwise(c)

    return (
        F.when(kind.isin(*NUMBERS), spaced(lambda c: (c >= "0") & (c <= "9")))
        .when(kind == "iban", spaced(lambda c: c != " "))
        .when(kind.isin("email", "token", "ipv6"), F.array_join(F.transform(F.split(surrogate, ""), cased), ""))
        .otherwise(surrogate)
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """``kind, canonical, surrogate`` for distinct ``kind, canonical``: distinct, and none of them a real entity.

    Surrogates that meet, or that occur in the corpus, are drawn again; the
    entity that is first by name keeps its own. Each round leaves few, and those
    that are left grow, so the rounds end whatever the corpus holds.
    """
    now = staged(entities.select("kind", "canonical", F.lit(0).alias("attempt")), "entities")
    real = now.select("kind", F.col("canonical").alias("surrogate"))
    while True:
        drawn = staged(now.withColumn("surrogate", _surrogate(F.col("kind"), F.col("canonical"), F.col("attempt"), key)), "surrogates")
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canonical").alias("first"), F.count(F.lit(1)).alias("n"))
        taken = first.join(real.withColumn("real", F.lit(True)), ["kind", "surrogate"], "left")
        bad = staged(taken.filter("n > 1 or real").select("kind", "surrogate", "first", "real"), "collisions")
        if bad.isEmpty():
            return drawn.select("kind", "canonical", "surrogate")
        again = F.col("real").isNotNull() | (F.col("first").isNotNull() & (F.col("first") != F.col("canonical")))
        now = drawn.join(bad, ["kind", "surrogate"], "left").select(
            "kind", "canonical", F.when(again, F.col("attempt") + 1).otherwise(F.col("attempt")).alias("attempt")
        )


def replaced(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced, and ``n_entities``, ``kinds``.

    The same entity gets the same surrogate everywhere, also in another format
    (letter case of an address, separators of a number); different entities
    get different ones. A name is replaced word by word, and its words also where
    the document has them without the title. Surrogates keep kind, script, case
    and separators, and the length unless a format runs out of values; numbers
    keep their first digit, cards and bank accounts valid check digits, countries
    of phones and banks stay, names keep their title and their ending, by which
    given names mostly tell the gender. Letters of a script outside SCRIPTS and
    RANGES stay, and the surrogate grows by letters instead.

    Only texts with a hint are searched, once; the marked texts are written, and
    cut at the marks from then on. Texts without personal data, NULL and empty
    ones stay as they are, with 0 entities and no kinds. Repeated rows and NULL
    ids are rows of their own. Other columns pass through whatever their names;
    new ones get a trailing underscore if their name is taken. An empty table
    gives an empty result; nothing raises.
    """
    n_entities, kinds = fresh(docs, "n_entities"), fresh(docs, "kinds")
    text = F.col(text_col).cast("string")
    may = F.coalesce(text.rlike(HINT), F.lit(False))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    hit = docs.filter(may).select(whole, _parts(_marked(text)).alias("parts"))
    hit = staged(hit.select("doc", _by_word(F.col("parts")).alias("parts"), F.monotonically_increasing_id().alias("row")), "marked")
    found = hit.select("row", F.posexplode("parts").alias("at", "entity")).filter("at % 2 = 1")
    raw = found.select("entity").distinct().withColumn("kind", _kind(F.col("entity")))
    raw = staged(raw.withColumn("canonical", _canonical(F.col("entity"), F.col("kind"))), "raw")
    drawn = surrogates(raw.select("kind", "canonical").distinct(), key)
    named = raw.join(drawn, ["kind", "canonical"]).select(
        "entity", "kind", _formatted(F.col("entity"), F.col("kind"), F.col("surrogate")).alias("new")
    )
    named = staged(named, "replacements")
    per_row = found.join(named, "entity").groupBy("row").agg(
        F.map_from_entries(F.collect_list(F.struct("at", "new"))).alias("new"), F.array_sort(F.collect_set("kind")).alias("kinds")
    )
    joined = hit.join(staged(per_row, "per_row"), "row", "left")
    put = F.transform("parts", lambda p, i: F.coalesce(F.try_element_at("new", i), _unescaped(p)))
    out = F.when(F.col("new").isNull(), F.col(f"doc.`{text_col}`").cast("string")).otherwise(F.array_join(put, ""))
    done = joined.select(
        *[out.alias(c) if c == text_col else F.col(f"doc.`{c}`").alias(c) for c in docs.columns],
        F.coalesce(F.size("new"), F.lit(0)).cast("long").alias(n_entities),
        F.coalesce(F.array_join("kinds", ","), F.lit("")).alias(kinds),
    )
    same = [text.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    rest = docs.filter(~may).select(*same, F.lit(0).cast("long").alias(n_entities), F.lit("").alias(kinds))
    return done.unionByName(rest)

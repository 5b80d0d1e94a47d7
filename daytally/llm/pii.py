"""Replace personal data and secrets by surrogates, with DataFrame functions only.

Entities are found by pattern and taken apart: an address into its name and domain, a person's name into its words, a
phone number into country code and rest. Every distinct part gets one surrogate, derived from a keyed hash of its
kind and value, for the whole table. So a name, address or number is the same person's wherever it comes back, also
when it is written with other separators or in other case. A surrogate keeps what the part looks like: digits stay
digits and letters stay letters of their script and case, separators stay in place, given names keep the gender of the
title, card numbers their first digit and a valid check digit, IP addresses stay addresses. A name after a title that
tells no gender is the gendered one's where all other titles of that given name agree. Words of a found name that come
back later in the text, without a title, get the same surrogate.

Two parts that would get the same surrogate, or one that would get a value that the table itself holds, are hashed again
until all are distinct; after MORE_AFTER tries the surrogate gets longer, so that a kind whose values are used up still
ends. Only the table of distinct parts is checked. Texts with entities are found in one reading, which is kept, and those without
in another; the latter are never moved.
"""

from __future__ import annotations

import hashlib
import secrets
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daytally.llm.common import cut

#: The session's setting that holds the key of the surrogates.
KEY_SETTING = "spark.daytally.surrogateKey"
MORE_AFTER = 8

# Titles by gender, and the letters that surrogates are made of, by script.
_MALE = "Mr|Sir|Herrn|Herr|Monsieur|Señor|Sr|Господин"
_FEMALE = "Mrs|Ms|Miss|Lady|Frau|Madame|Mme|Mlle|Señora|Sra|Госпожа"
_NEUTRAL = "Dr|Prof"
_SCRIPTS = (
    ("[a-z]", "abcdefghijklmnopqrstuvwxyz"),
    ("[а-яё]", "абвгдежзиклмнопрстуфхцчшэюя"),
    ("[α-ωά-ώ]", "αβγδεζηθικλμνξοπρστυφχψω"),
    ("[\\u05d0-\\u05ea]", "אבגדהוזחטיכלמנסעפצקרשת"),
    ("[\\u0620-\\u064a]", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي"),
    ("[\\u3040-\\u30ff]", "あいうえおかきくけこさしすせそたちつてとなにぬねの"),
    ("[\\u4e00-\\u9fff]", "王李张刘陈杨黄赵周吴徐孙朱马胡郭林何高梁"),
    ("[\\uac00-\\ud7a3]", "가나다라마바사아자차카타파하고노도로모보"),
    ("\\p{L}", "àâäåçèéêëíîïñóôöøúûü"),
)
_SYLLABLES = {
    "latin": "ba de ki lo mu ra se ti no pa ge fu li ma re so ta ve wi zu".split(),
    "cyrillic": "ба де ки ло му ра се ти но па ге фу ли ма ре со та ве зи ку".split(),
}
_ENDINGS = {
    "latin": {"given_m": ["n", "s", "k", "ro"], "given_f": ["na", "la", "ia", "ra"], "given_u": ["", "l"], "surname": ["rd", "ner", "lt", "m"]},
    "cyrillic": {"given_m": ["н", "р", "й", "с"], "given_f": ["на", "ла", "я", "ра"], "given_u": ["", "л"], "surname": ["ров", "нин", "к", "рт"]},
}

# Words that stand between given name and surname, words that announce a card number.
_PARTICLE = "de|del|della|der|den|di|da|du|la|le|van|von|ter|zu|bin|al"
_CARD_WORD = "card|visa|mastercard|amex|carte|karte|tarjeta|карта|карты"
# Letters that initials are made of.
_INITIALS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ")

# Where a match starts is told by one letter first, so that most places of a text cost one look.
_FIRST = "".join(sorted({title[0] for title in f"{_MALE}|{_FEMALE}|{_NEUTRAL}".split("|")}))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_HEX = "[0-9a-fA-F]{1,4}"
_NAME = r"(?:\p{Lu}['’])?\p{Lu}\p{L}++(?:-\p{Lu}\p{L}++)?"
# Han names are short and followed by text without a blank; other scripts without case end their words.
_CASELESS = r"(?:\p{IsHan}{2,4}|(?!\p{IsHan})\p{Lo}{2,20}+)"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)+",
    "secret": r"(?<![\p{L}\p{N}])(?:[0-9a-fA-F]{32,128}|AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64})(?![\p{L}\p{N}])",
    "ip": rf"(?=\d)(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)",
    "ipv6": rf"(?<![\p{{L}}\p{{N}}:.])(?=[a-fA-F:]*+\d)(?:(?:{_HEX}:){{7}}{_HEX}|{_HEX}(?::{_HEX}){{0,5}}::(?:{_HEX}(?::{_HEX}){{0,5}})?)(?![\p{{L}}\p{{N}}:])",
    "phone": r"(?=[\d+(])(?<![\d+])(?:\+1(?:[ .\-]?\(?\d\)?){10}(?!\d)|\+1(?:[ .\-]?\d){7}(?![ .\-]?\d)|\+[2-9]\d{0,2}(?:[ .\-]?\(?\d\)?){7,11}(?!\d)"
    r"|\(\d{3}\) ?\d{3}[.\-]\d{4}|\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4}|0\d{2,4}[ \-]\d{3,4}[ \-]\d{3,4})(?!\d)",
    "ssn": r"(?<![\d\-])\d{3}-\d{2}-\d{4}(?![\d\-])",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "card": r"(?<![\p{L}\p{N}.\-])(?:\d{13,19}|\d{4}(?:[ \-]\d{4}){3}(?:[ \-]\d{1,3})?|\d{4}[ \-]\d{6}[ \-]\d{5})(?![\p{L}\p{N}])",
    "person": rf"(?=[{_FIRST}])(?<![\p{{L}}\p{{N}}])(?:{_MALE}|{_FEMALE}|{_NEUTRAL})\.? (?:(?:\p{{Lu}}\.|{_PARTICLE}|{_NAME}) ){{0,3}}(?:{_NAME}|{_CASELESS})",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# What a text with an entity holds at least; cheaper than the patterns.
_HEADS = r"AKIA|sk-|gh[pousr]_"
_HINT = (
    rf"[0-9@]|[a-fA-F]{{32}}|(?=[Asg{_FIRST}])(?<![\p{{L}}\p{{N}}])"
    rf"(?:{_HEADS}|(?:{_MALE}|{_FEMALE}|{_NEUTRAL})\.? (?:[\p{{Lu}}\p{{Lo}}]|(?:{_PARTICLE}) ))"
)
# A word that may be a found name's, wherever it stands.
_WORD = rf"(?<![\p{{L}}\p{{N}}]){_NAME}(?![\p{{L}}\p{{N}}])"
_PLAIN = ("ip", "ipv6", "domain", "given_m", "given_f", "given_u", "surname")
_NAMES = ("surname", "given_m", "given_f", "given_u")


def session_key(spark: SparkSession) -> str:
    """The key that the session names in KEY_SETTING; where it names none, a random one that holds for the session."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        key = secrets.token_hex(32)
        spark.conf.set(KEY_SETTING, key)
    return key


def _part(kind: Column | str, value: Column) -> Column:
    return F.struct((F.lit(kind) if isinstance(kind, str) else kind).alias("kind"), value.alias("value"))


def _letters_and_digits(value: Column) -> Column:
    return F.lower(F.regexp_replace(value, r"[^\p{L}\p{N}]", ""))


def _kind(found: Column, before: Column) -> Column:
    """The kind of a match, `keep` if it is a number in the shape of a card's that nothing else speaks for.

    For a card speak a valid check digit (unless it is a book's number), a word before it, and 16 digits without blanks.
    """
    whole = {kind: f"^(?:{PATTERNS[kind]})$" for kind in PATTERNS}
    digits = F.regexp_replace(found, "[^0-9]", "")
    announced = F.regexp_like(F.right(before, F.lit(40)), F.lit(rf"(?i)(?:{_CARD_WORD})\P{{N}}{{0,24}}$"))
    book = F.regexp_like(digits, F.lit(r"^97[89]\d{10}$"))
    card = announced | F.regexp_like(found, F.lit(r"^\d{16}$")) | (~book & (_luhn(digits) % 10 == 0))
    pairs = [(F.regexp_like(found, F.lit(p)), kind) for kind, p in whole.items()]
    kinds = [F.when(is_kind, F.when(card, kind).otherwise("keep") if kind == "card" else F.lit(kind)) for is_kind, kind in pairs]
    return F.coalesce(*kinds)


def _rotated(key: str) -> str:
    """The initials, each alphabet turned by a number of places that the key tells, so that no two become one."""
    turns = [1 + int.from_bytes(hashlib.sha256(f"{key} {x}".encode()).digest()[:8], "big") % (len(x) - 1) for x in _INITIALS]
    return "".join(x[n:] + x[:n] for x, n in zip(_INITIALS, turns, strict=True))


def _parts(entity: Column, key: str) -> Column:
    """A found entity as an array of (kind, value): `keep` for what stays, else the kind and the text as written."""
    kind, found = entity["kind"], entity["found"]
    address = [_part("local", F.substring_index(found, "@", 1)), _part("keep", F.lit("@")), _part("domain", F.substring_index(found, "@", -1))]
    code = F.regexp_extract(found, r"^\+\d{1,3}(?=[ .\-(])", 0)
    phone = [_part("keep", code), _part("phone", F.substring(found, F.length(code) + 1, F.length(found)))]
    iban = [_part("keep", F.substring(found, 1, 2)), _part("iban", F.substring(found, 3, 64))]
    title = F.regexp_extract(found, r"^\p{L}+\.?", 0)
    bare = F.regexp_replace(title, r"\.$", "")
    gender = F.when(F.regexp_like(bare, F.lit(f"^(?:{_MALE})$")), "given_m").when(F.regexp_like(bare, F.lit(f"^(?:{_FEMALE})$")), "given_f").otherwise("given_u")
    names = F.split(F.substring(found, F.length(title) + 2, F.length(found)), " ")

    def name(x: Column, i: Column) -> Column:
        initial = F.regexp_like(x, F.lit(r"^\p{Lu}\.$"))
        role = F.when(i == F.size(names) - 1, "surname").when(initial | F.regexp_like(x, F.lit(f"^(?:{_PARTICLE})$")), "keep").otherwise(gender)
        other = F.translate(x, "".join(_INITIALS), _rotated(key))
        return F.array(_part("keep", F.lit(" ")), _part(role, F.when(initial, other).otherwise(x)))

    named = F.transform(names, name)
    person = F.concat(F.array(_part("keep", title)), F.flatten(named))
    return (
        F.when(kind == "email", F.array(*address))
        .when(kind == "phone", F.array(*phone))
        .when(kind == "iban", F.array(*iban))
        .when(kind == "person", person)
        .otherwise(F.array(_part(kind, found)))
    )


def _value(kind: Column, written: Column) -> Column:
    """What two ways to write the same part have in common."""
    plain = kind.isin(*_PLAIN)
    return F.when(plain, F.lower(written)).otherwise(_letters_and_digits(written))


def _byte(digest: Column, i: Column) -> Column:
    """The i-th pseudo-random number below 256, from 0."""
    pair = F.substring(digest, F.lit(1) + 2 * (i % 64), F.lit(2))
    return (F.conv(pair, 16, 10).cast("int") + 37 * F.floor(i / 64)).cast("int") % 256


def _letter(letters: str, n: Column) -> Column:
    return F.substring(F.lit(letters), F.lit(1) + n % len(letters), F.lit(1))


def _in_kind(value: Column, digest: Column, kind: Column) -> Column:
    """Each digit and letter replaced by another of its sort; a secret's letters stay hexadecimal if they are."""
    hexadecimal = (kind == "ipv6") | ((kind == "secret") & F.regexp_like(value, F.lit("^[0-9a-f]+$")))

    def other(i: Column) -> Column:
        c, n = F.substring(value, i, F.lit(1)), _byte(digest, i - 1)
        out = F.when(F.regexp_like(c, F.lit(r"\d")), (n % 10).cast("string"))
        out = out.when(hexadecimal & F.regexp_like(c, F.lit("[a-f]")), _letter("abcdef", n))
        for script, letters in _SCRIPTS:
            out = out.when(F.regexp_like(c, F.lit(script)), _letter(letters, n))
        return out.otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), other), "")


def _luhn(digits: Column) -> Column:
    """The weighted digit sum whose last digit is 0 for a valid number."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add)


def _card(value: Column, digest: Column, kind: Column) -> Column:
    other = F.concat(F.substring(value, 1, 1), _in_kind(F.substring(value, F.lit(2), F.length(value) - 1), digest, kind))
    open_end = F.concat(F.substring(other, F.lit(1), F.length(other) - 1), F.lit("0"))
    checked = F.concat(F.substring(other, F.lit(1), F.length(other) - 1), ((10 - _luhn(open_end) % 10) % 10).cast("string"))
    return F.when(_luhn(value) % 10 == 0, checked).otherwise(other)


def _given(value: Column, digest: Column, kind: Column) -> Column:
    """A name of syllables, in the script of the old one, whose ending shows the gender."""

    def name(script: str) -> Column:
        syllables = F.array(*map(F.lit, _SYLLABLES[script]))
        stem = [F.element_at(syllables, 1 + _byte(digest, F.lit(i)) % len(_SYLLABLES[script])) for i in range(3)]
        ending = reduce(
            lambda out, k: out.when(kind == k[0], F.element_at(F.array(*map(F.lit, k[1])), 1 + _byte(digest, F.lit(9)) % len(k[1]))),
            _ENDINGS[script].items(),
            F.when(F.lit(False), ""),
        )
        return F.concat(*stem, ending)

    return (
        F.when(F.regexp_like(value, F.lit("^[а-яё\\-]+$")), name("cyrillic"))
        .when(F.regexp_like(value, F.lit("^[\\p{IsLatin}\\-'’]+$")), name("latin"))
        .otherwise(_in_kind(value, digest, kind))
    )


def _digest(key: str) -> Column:
    return F.sha2(F.concat_ws("\0", F.lit(key), "kind", "value", F.col("tries").cast("string")).cast("binary"), 512)


def _surrogate(kind: Column, value: Column, tries: Column, digest: Column) -> Column:
    octets = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: (1 + _byte(digest, i) % 223).cast("string"))
    top = F.regexp_extract(value, r"\.[^.]+$", 0)
    domain = F.concat(_in_kind(F.substring(value, F.lit(1), F.length(value) - F.length(top)), digest, kind), top)
    extra = F.substring(F.translate(digest, "abcdef", "012345"), F.lit(100), tries - MORE_AFTER)
    more = F.when(tries > MORE_AFTER, extra).otherwise("")
    made = (
        F.when(kind == "ip", F.array_join(octets, "."))
        .when(kind == "card", _card(value, digest, kind))
        .when(kind.isin(*_NAMES), _given(value, digest, kind))
        .when(kind == "domain", F.concat(more, domain))
        .otherwise(_in_kind(value, digest, kind))
    )
    return F.when(kind.isin("ip", "domain"), made).otherwise(F.concat(made, more))


def surrogates(parts: DataFrame, key: str | None = None) -> DataFrame:
    """From distinct (kind, value), a surrogate for each: distinct within a kind, and none equal to a value of the kind.

    Without a key, the session's (`session_key`).
    """
    spark = parts.sparkSession
    key = key or session_key(spark)
    # Few bytes, but much work for each: dealt to all tasks, however small the table is.
    parts = cut(parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "kind", "value"))
    values = parts.select(F.col("kind").alias("held_kind"), F.col("value").alias("held"))
    named = parts.withColumn("tries", F.lit(0))
    while True:
        # A column by itself, so that it is worked out once and not for every character.
        named = named.withColumn("digest", _digest(key))
        made = _surrogate(F.col("kind"), F.col("value"), F.col("tries"), F.col("digest"))
        named = cut(named.select("kind", "value", "tries", made.alias("surrogate")))
        twice = named.groupBy("kind", "surrogate").agg(F.min("value").alias("first"), F.count("*").alias("n")).where("n > 1")
        twice = twice.select(F.col("kind").alias("twice_kind"), F.col("surrogate").alias("twice"), "first")
        again = (F.col("first").isNotNull() & (F.col("first") != F.col("value"))) | F.col("held").isNotNull()
        checked = named.join(twice, (F.col("kind") == F.col("twice_kind")) & (F.col("surrogate") == F.col("twice")), "left")
        checked = checked.join(values, (F.col("kind") == F.col("held_kind")) & (F.col("surrogate") == F.col("held")), "left")
        checked = cut(checked.select("kind", "value", "tries", "surrogate", again.alias("again")))
        if checked.where("again").isEmpty():
            return checked.select("kind", "value", "surrogate")
        named = checked.select("kind", "value", (F.col("tries") + F.col("again").cast("int")).alias("tries"))


def _written(surrogate: Column, written: Column, kind: Column) -> Column:
    """A surrogate in the separators and case of what it replaces."""
    first = F.substring(written, 1, 1)
    upper = (written == F.upper(written)) & (written != F.lower(written))
    words = (
        F.when(upper & (F.length(written) > 1), F.upper(surrogate))
        .when(first != F.lower(first), F.concat(F.upper(F.substring(surrogate, 1, 1)), F.substring(surrogate, F.lit(2), F.length(surrogate))))
        .otherwise(surrogate)
    )

    def at(i: Column) -> Column:
        c = F.substring(written, i, F.lit(1))
        place = F.length(F.regexp_replace(F.substring(written, F.lit(1), i), r"[^\p{L}\p{N}]", ""))
        new = F.substring(surrogate, place, F.lit(1))
        return F.when(F.regexp_like(c, F.lit(r"[^\p{L}\p{N}]")), c).when(c != F.lower(c), F.upper(new)).otherwise(new)

    filled = F.array_join(F.transform(F.sequence(F.lit(1), F.length(written)), at), "")
    rest = F.substring(surrogate, F.length(_letters_and_digits(written)) + 1, F.length(surrogate))
    plain = kind.isin(*_PLAIN)
    return F.when(plain, words).otherwise(F.concat(filled, rest))


def _genders(parts: DataFrame) -> DataFrame:
    """Distinct (kind, value) with `asked`, the kind whose surrogate it gets: a given name's one gender, if it has one."""
    gendered = parts.where(F.col("kind").isin("given_m", "given_f")).groupBy(F.col("value").alias("of"))
    gendered = gendered.agg(F.min("kind").alias("low"), F.max("kind").alias("high")).where("low = high")
    settled = F.when(F.col("kind") == "given_u", F.col("low"))
    return parts.join(gendered, F.col("value") == F.col("of"), "left").select(
        "kind", "value", F.coalesce(settled, "kind").alias("asked")
    )


def with_surrogates(docs: DataFrame, key: str | None = None, name: str = "n_entities") -> DataFrame:
    """The rows of `docs` with entities in `text` replaced and their number in column `name`; other columns stay.

    - A null text stays null with 0 entities; texts of any length are searched whole.
    - Rows that repeat, or whose ids are null or repeat, are treated alike; equal parts get equal surrogates everywhere.
    - An empty table gives an empty result. A column called `name` is replaced.
    - A name counts as a person's where a title stands before it; capitalised words of it are then replaced all over the
      text. These are not entities of their own. A name in a script without case has two letters at least.
    - A number in the shape of a card's stays where neither its check digit nor a word before it speaks for a card.
    - Without a key, the session's is taken (`session_key`).
    """
    key = key or session_key(docs.sparkSession)
    text = F.col("text")
    hinted = F.regexp_like(text, F.lit(_HINT))
    marked = docs.withColumn("_texts", F.when(hinted, F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0))))
    marked = marked.withColumn("_texts", F.coalesce("_texts", F.array().cast("array<string>")))
    # What stands between the entities, taken apart once.
    marked = marked.withColumn("_between", F.when(F.size("_texts") > 0, F.split(text, ENTITY, -1)))
    kinds = F.zip_with("_texts", F.slice("_between", 1, F.size("_texts")), lambda x, b: F.struct(_kind(x, b).alias("kind"), x.alias("found")))
    nothing = F.array().cast("array<struct<kind: string, found: string>>")
    marked = marked.withColumn("_found", F.when(F.size("_texts") > 0, kinds).otherwise(nothing)).drop("_texts")
    marked = marked.withColumn("_n", F.size(F.filter("_found", lambda x: x["kind"] != "keep")).cast("long"))
    # Rows without an id go by their text, so that they are no hot key.
    row = F.coalesce(F.col("doc_id").cast("string"), F.md5(text.cast("binary")))
    # Kept, so that the texts with entities are searched once; the text itself is what lies between and what was found.
    some = cut(marked.where(F.col("_n") > 0).withColumn("_row", row).drop("text"))
    pairs = some.select(F.col("_row").alias("row"), F.explode(F.array_distinct("_found")).alias("found"))
    pairs = pairs.select("row", F.explode(_parts(F.col("found"), key)).alias("part")).select("row", "part.kind", "part.value")
    pairs = pairs.where("kind <> 'keep'").select("row", "kind", _value(F.col("kind"), F.col("value")).alias("value"))
    pairs = cut(pairs.distinct())
    parts = cut(_genders(pairs.select("kind", "value").distinct()))
    made = surrogates(parts.select(F.col("asked").alias("kind"), "value").distinct(), key)
    made = made.withColumnsRenamed({"kind": "asked", "value": "of"})
    named = parts.join(made, (parts["asked"] == made["asked"]) & (F.col("value") == F.col("of"))).select("kind", "value", "surrogate")
    entry = F.struct(F.concat_ws(":", "kind", "value"), "surrogate")
    maps = pairs.join(named, ["kind", "value"]).groupBy(F.col("row").alias("_of")).agg(
        F.map_from_entries(F.collect_set(entry)).alias("_map")
    )
    some = some.join(maps, F.col("_row") == F.col("_of"))
    some = some.withColumn("text", _replaced(F.col("_between"), F.col("_found"), F.col("_map"), key))
    none = marked.where(F.col("_n") == 0)
    out = [c for c in docs.columns if c != name]
    n = F.col("_n").alias(name)
    return none.select(*out, n).unionAll(some.select(*out, n))


def _replaced(between: Column, found: Column, names: Column, key: str) -> Column:
    def looked_up(part: Column) -> Column:
        surrogate = names[F.concat_ws(":", part["kind"], _value(part["kind"], part["value"]))]
        return F.struct(part["kind"].alias("kind"), part["value"].alias("value"), surrogate.alias("surrogate"))

    def new(part: Column) -> Column:
        written = _written(part["surrogate"], part["value"], part["kind"])
        return F.when(part["kind"] == "keep", part["value"]).otherwise(written)

    def again(word: Column) -> Column:
        met = F.coalesce(*[names[F.concat(F.lit(f"{kind}:"), F.lower(word))] for kind in _NAMES])
        return F.when(met.isNull(), word).otherwise(_written(met, word, F.lit("surname")))

    def woven(gaps: Column, new: Column) -> Column:
        return F.array_join(F.flatten(F.zip_with(gaps, new, lambda a, b: F.array(a, F.coalesce(b, F.lit(""))))), "")

    def mentions(piece: Column) -> Column:
        return woven(F.split(piece, _WORD, -1), F.transform(F.regexp_extract_all(piece, F.lit(_WORD), F.lit(0)), again))

    entities = F.transform(found, lambda x: F.array_join(F.transform(F.transform(_parts(x, key), looked_up), new), ""))
    persons = F.exists(found, lambda x: x["kind"] == "person")
    return woven(F.when(persons, F.transform(between, mentions)).otherwise(between), entities)

"""PII: surrogate generation, in DataFrame functions only.

Detected entities get keyed surrogates of their type, format, script and (given names) gender. A surrogate depends on
the key and the entity's canonical form alone, so all mentions of an entity in all documents stay one entity. The
distinct entities of the corpus are checked together: a surrogate that another entity has, or that is itself an entity
of the corpus, is drawn again until all are distinct. Given names change places within their list, by the key; surnames
keep an ending that tells gender.
"""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import salted_join, written

#: Given names by gender and script.
GIVEN = {
    ("male", "latin"): "James John Robert Michael William David Richard Joseph Thomas Charles Daniel Matthew Anthony Peter Hans Jürgen Klaus Pierre Jacques Luc Carlos José Miguel Pablo",
    ("female", "latin"): "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Emily Anna Laura Ingrid Heike Ursula Marie Sophie Camille Claire María Lucía Carmen Elena",
    ("male", "cyrillic"): "Иван Александр Дмитрий Сергей Андрей Михаил Николай Владимир Олег Павел",
    ("female", "cyrillic"): "Анна Елена Ольга Наталья Татьяна Ирина Светлана Мария Екатерина Юлия",
}
#: Titles before a surname.
TITLES = "Mr Mrs Ms Miss Mme Monsieur Madame Herr Frau Herrn Señor Señora Sr Sra Dr Prof Господин Госпожа"
#: Endings of surnames that tell gender.
GENDERED = "ов ова ев ева ёв ёва ин ина ын ына ский ская цкий цкая ой ая ий ый"
ATTEMPTS = 12
DEFAULT_KEY = "change this key"
#: Bytes of text in a task of patterns, up to MANY_TASKS of them, and beyond.
SMALL_TASK, MANY_TASKS, LARGE_TASK = 1 << 20, 4096, 1 << 26


def _any(words: str) -> str:
    return "|".join(sorted(words.split(), key=lambda w: (-len(w), w)))


_GIVEN, _TITLE = _any(" ".join(GIVEN.values())), _any(TITLES)
_B, _E = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,24}" + _E
ASSIGNED = r"""(?i:token|secret|password|passwd|api[_-]?key|access[_-]?key)["']?\s{0,3}[:=]"""
SECRET = (
    rf"""(?<={ASSIGNED}\s{{0,3}}["']?)(?=[A-Za-z0-9+/_=-]{{8}})[A-Za-z0-9+/_=-]+"""
    r"|" + _B + r"(?:AKIA|ASIA)[0-9A-Z]{16}" + _E + "|" + _B + r"gh[pousr]_[A-Za-z0-9]{36,}" + _E
)
IBAN = _B + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _E
IP = r"(?<![\p{L}\p{N}_.])(?:" + _OCTET + r"\.){3}" + _OCTET + r"(?![\p{L}\p{N}_]|\.\d)"
IPV6 = r"(?<![\p{L}\p{N}_:.])(?=[0-9A-Fa-f]{0,3}\d)(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}|[0-9A-Fa-f]{3,4}(?::[0-9A-Fa-f]{1,4}){0,6}::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,5})?)(?![\p{L}\p{N}_:])"
SSN = r"(?<![\p{L}\p{N}_-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}_-])"
CARD = r"(?<![\p{L}\p{N}_])\d(?:[ -]?\d){12,18}" + _E
PHONE = r"(?<![\p{L}\p{N}_])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{3}[ .-])\d{3,4}[ .-]\d{4}" + _E + r"|(?<![\p{L}\p{N}_])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}" + _E
NAME = rf"{_B}(?:{_GIVEN})(?= \p{{Lu}}\p{{L}})|(?<={_B}(?:{_GIVEN}) )\p{{Lu}}[\p{{L}}’'-]+|(?<={_B}(?:{_TITLE})\.? )\p{{Lu}}[\p{{L}}’'-]+"
#: What may be private, leftmost first and in this order at one place.
MASTER = "|".join((EMAIL, SECRET, IBAN, IP, IPV6, SSN, CARD, PHONE, NAME))
#: Texts without a match hold no entity, as each part of MASTER needs one: a digit (IBAN, IP, IPV6, SSN, CARD, PHONE), an at sign
#: (EMAIL), SECRET's own assignment or the start of a bare key, a title or a given name before a capital (NAME).
CHEAP = rf"[0-9@]|{ASSIGNED}|AKIA|ASIA|gh[pousr]_|(?<![\p{{L}}])(?=\p{{Lu}})(?:{_GIVEN}|{_TITLE})\.? \p{{Lu}}"


def chars(s: Column) -> Column:
    return F.filter(F.split(s, ""), lambda c: c != "")


def luhn(digits: Column) -> Column:
    """The Luhn sum of a digit string modulo 10: 0 for a valid card number."""
    twice = lambda d, i: F.when(i % 2 == 0, d).otherwise(F.when(d > 4, d * 2 - 9).otherwise(d * 2))
    each = F.transform(F.reverse(chars(digits)), lambda c, i: twice(c.cast("int"), i))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10


def mod97(s: Column) -> Column:
    """The remainder of an IBAN (blanks out, capitals) as the standard reads it: first four characters last, letters as 10 to 35."""
    turned = F.concat(F.substring(s, 5, 64), F.substring(s, 1, 4))
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(chars(turned), F.lit(0), lambda a, c: (a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c)) % 97)


def kind_of(m: Column) -> Column:
    """The type of a match of MASTER; null where a closer look shows that it is none (no card's check digit, say)."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    given = F.array(*[F.lit(n.lower()) for names in GIVEN.values() for n in names.split()])
    return (
        F.when(m.contains("@"), "email")
        .when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
        .when(m.rlike("^[0-9A-Fa-f:]*:[0-9A-Fa-f]*:[0-9A-Fa-f:]*$"), "ipv6")
        .when(m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
        .when(m.rlike(r"^\d(?:[ -]?\d){12,18}$"), F.when((luhn(digits) == 0) & digits.rlike("^[3-6]"), "card"))
        .when(m.rlike(r"^[+(]?\d[\d() .-]*$"), "phone")
        .when(m.rlike(r"^[A-Z]{2}\d{2}[A-Z0-9 ]{10,}$") & (mod97(F.regexp_replace(m, " ", "")) == 1), "iban")
        .when(m.rlike(r"^[A-Z]{2}\d{2} "), F.lit(None))
        .when(F.array_contains(given, F.lower(m)), "given")
        .when(m.rlike(r"^\p{Lu}[\p{L}’'-]+$"), "surname")
        .when(m.rlike(r"^[A-Za-z0-9+/_=-]{8,}$"), "secret")
    )


def canonical(kind: Column, m: Column) -> Column:
    """What all mentions of an entity share: digits of cards and phones, else lower case; secrets as they are but for hexadecimal ones."""
    return (
        F.when(kind.isin("card", "phone", "ssn"), F.regexp_replace(m, "[^0-9]", ""))
        .when(kind == "iban", F.regexp_replace(m, " ", ""))
        .when((kind == "secret") & ~m.rlike("^[0-9a-fA-F]+$"), m)
        .otherwise(F.lower(m))
    )


def given_map(key: str) -> dict[str, str]:
    """Lower-case given names, each to another of its gender and script, one to one: the next in an order that the key makes."""
    out = {}
    for group, names in sorted(GIVEN.items()):
        order = sorted(names.split())
        random.Random(hashlib.sha256(f"{key}|{group}".encode()).hexdigest()).shuffle(order)
        out |= {a.lower(): b.lower() for a, b in zip(order, order[1:] + order[:1])}
    return out


#: Letters that stand for one another in a surrogate.
ALPHABETS = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ", "áâàäãéêèëíîìïóôòöõúûùü", "çñß", "аеиоуыэюя", "бвгджзклмнпрстфхцчш", "αεηιουω", "βγδζθκλμνξπρστφχψ")


def drawn(kind: Column, canon: Column, attempt: Column, key: str) -> Column:
    """The surrogate of a canonical form, character by character within the character's alphabet, from a keyed hash."""
    salt = F.concat_ws("|", F.lit(key), kind, canon, attempt.cast("string"))
    stream = F.concat(F.sha2(salt, 512), F.sha2(F.concat(salt, F.lit("|+")), 512))
    at = lambda i: F.conv(stream.substr(i % 128 * 2 + 1, F.lit(2)), 16, 10).cast("int")
    hexed = (kind == "secret") & canon.rlike("^[0-9a-f]+$") | (kind == "ipv6")
    ending = F.length(F.regexp_extract(canon, f"^..+?({_any(GENDERED)})$", 1))
    tail = F.when(kind == "email", F.length(F.regexp_extract(canon, r"\.([^.]*)$", 1))).when(kind == "surname", ending).otherwise(0)  # top domain, gender
    network = F.length(F.regexp_extract(canon, "^([^:]*:)", 1))
    same = F.when(kind == "iban", 2).when(kind == "phone", F.greatest(F.length(canon) - 10, F.lit(0))).when(kind == "ipv6", network).otherwise(0)  # country, country code, network

    def one(c: Column, i: Column) -> Column:
        out = F.when((i < same) | (i >= F.length(canon) - tail) | (c == ":"), c).when(hexed, F.lit("0123456789abcdef").substr(at(i) % 16 + 1, F.lit(1)))
        first = (i == 0) & (c != "0") & (kind != "secret")
        out = out.when(first & c.rlike("[0-9]"), F.lit("123456789").substr(at(i) % 9 + 1, F.lit(1)))
        for letters in ALPHABETS:
            out = out.when(F.lit(letters).contains(c), F.lit(letters).substr(at(i) % len(letters) + 1, F.lit(1)))
        return out.otherwise(c)

    plain = F.array_join(F.transform(chars(canon), one), "")

    def octet(o: Column, i: Column) -> Column:
        return F.when(F.length(o) == 3, 100 + at(i) % 155).when(F.length(o) == 2, 10 + at(i) % 90).otherwise(1 + at(i) % 9).cast("string")

    head = F.concat(F.lit("345").substr(at(F.lit(0)) % 3 + 1, F.lit(1)), F.substring(plain, 2, 64).substr(F.lit(1), F.length(canon) - 2))
    card = F.concat(head, ((10 - luhn(F.concat(head, F.lit("0")))) % 10).cast("string"))
    bare = F.concat(F.substring(plain, 1, 2), F.lit("00"), F.substring(plain, 5, 64))
    iban = F.concat(F.substring(bare, 1, 2), F.lpad((98 - mod97(bare)).cast("string"), 2, "0"), F.substring(bare, 5, 64))
    given = F.create_map(*[F.lit(x) for kv in given_map(key).items() for x in kv])
    return (
        F.when(kind == "ip", F.array_join(F.transform(F.split(canon, r"\."), octet), "."))
        .when(kind == "card", card)
        .when(kind == "iban", iban)
        .when(kind == "given", given[canon])
        .otherwise(plain)
    )


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, canon, fake) for the distinct (kind, canon) given, with distinct fakes that are no entity themselves.

    Of entities that draw the same fake, the first in order keeps it and the others draw again, up to ATTEMPTS times;
    one that is still unlucky (its format has no free value left) gets a numbered ending taken from a hash. Given
    names are a one-to-one exchange within a list, so they need no second draw.
    """
    entities = written(entities, "entities")
    taken = entities.select("kind", F.col("canon").alias("fake"))
    pending, done = entities, None
    for attempt in range(ATTEMPTS):
        tried = pending.withColumn("fake", drawn(F.col("kind"), F.col("canon"), F.lit(attempt), key))
        own = F.row_number().over(Window.partitionBy("kind", "fake").orderBy("canon"))
        marked = tried.withColumn("own", own).join(taken.withColumn("used", F.lit(True)).distinct(), ["kind", "fake"], "left")
        ok = (F.col("kind") == "given") | (F.col("own") == 1) & F.col("used").isNull()
        marked = written(marked.select("kind", "canon", "fake", ok.alias("ok")), "surrogates")
        won = marked.filter("ok").drop("ok")
        done = won if done is None else done.unionByName(won)
        pending = marked.filter("NOT ok").select("kind", "canon")
        if pending.isEmpty():
            return done
        taken = taken.unionByName(won.select("kind", "fake"))
    last = F.concat(drawn(F.col("kind"), F.col("canon"), F.lit(ATTEMPTS), key), F.lit("-"), F.substring(F.sha2(F.concat_ws("|", F.lit(key), "canon"), 256), 1, 16))
    return done.unionByName(pending.withColumn("fake", last))


def worn(kind: Column, mention: Column, fake: Column) -> Column:
    """``fake`` in the format of ``mention``: its separators and its case."""
    rank = lambda i: F.length(F.regexp_replace(mention.substr(F.lit(1), i + 1), "[^0-9]", ""))
    digits = F.array_join(F.transform(chars(mention), lambda c, i: F.when(c.rlike("[0-9]"), fake.substr(rank(i), F.lit(1))).otherwise(c)), "")
    spot = lambda i: F.length(F.regexp_replace(mention.substr(F.lit(1), i + 1), " ", ""))
    spaced = F.array_join(F.transform(chars(mention), lambda c, i: F.when(c == " ", c).otherwise(fake.substr(spot(i), F.lit(1)))), "")
    cased = F.array_join(F.transform(chars(mention), lambda c, i: F.when(c != F.lower(c), F.upper(fake.substr(i + 1, F.lit(1)))).otherwise(fake.substr(i + 1, F.lit(1)))), "")
    whole = F.length(mention) == F.length(fake)
    name = F.when((F.length(mention) > 1) & (mention == F.upper(mention)), F.upper(fake)).otherwise(F.concat(F.upper(F.substring(fake, 1, 1)), F.substring(fake, 2, 200)))
    return (
        F.when(kind.isin("card", "phone", "ssn") & (F.length(F.regexp_replace(mention, "[^0-9]", "")) == F.length(fake)), digits)
        .when((kind == "iban") & (F.length(F.regexp_replace(mention, " ", "")) == F.length(fake)), spaced)
        .when(kind.isin("given", "surname"), name)
        .when(kind.isin("email", "ipv6") | (kind == "secret") & fake.rlike("^[0-9a-f]+$") & mention.rlike("^[0-9a-fA-F]+$"), F.when((mention == F.upper(mention)) & mention.rlike("[A-Z]"), F.upper(fake)).when(whole, cased).otherwise(fake))
        .otherwise(fake)
    )


def anonymise(docs: DataFrame, key: str = DEFAULT_KEY) -> DataFrame:
    """``docs`` with text's entities replaced, all other columns kept, and n_entities long (mentions replaced).

    A null text stays null, an empty one empty, both with 0. Repeated rows are treated alike. An empty table gives no
    rows. A column named n_entities is replaced; other names can't clash.
    """
    columns = [c for c in docs.columns if c != "n_entities"]
    maybe = F.coalesce(F.col("text").rlike(CHEAP), F.lit(False))
    rest = docs.filter(~maybe).select(*columns, F.lit(0).cast("long").alias("n_entities"))
    base = docs.filter(maybe).select(F.struct(*columns).alias("row"), F.unhex(F.sha2("text", 256)).alias("tkey"))
    base = written(base, "maybe-private")
    # patterns are slow, so distinct texts are dealt over many tasks, and taken apart once
    size = base.agg(F.coalesce(F.sum(F.octet_length("row.text")), F.lit(0))).first()[0]
    tasks = max(1, min(size // SMALL_TASK, MANY_TASKS), size // LARGE_TASK)
    texts = base.groupBy("tkey").agg(F.any_value("row.text").alias("text")).repartition(tasks, "tkey")
    parts = texts.select("tkey", F.split("text", MASTER, -1).alias("gaps"), F.regexp_extract_all("text", F.lit(MASTER), F.lit(0)).alias("old"))
    parts = written(parts, "parts")  # not filtered before, as a filter on matches would be worked out ahead of the deal
    parts = parts.filter(F.size("old") > 0)
    found = (
        parts.select("tkey", F.posexplode("old").alias("at", "mention"))
        .withColumn("kind", kind_of(F.col("mention")))
        .filter("kind IS NOT NULL")
        .withColumn("canon", canonical(F.col("kind"), F.col("mention")))
    )
    found = written(found, "mentions")
    fakes = written(surrogates(found.select("kind", "canon").distinct(), key), "fakes")
    new = (
        salted_join(found.withColumn("entity", F.xxhash64("kind", "canon")), fakes.withColumn("entity", F.xxhash64("kind", "canon")).select("entity", F.col("kind").alias("k"), F.col("canon").alias("c"), "fake"), "entity", "tkey")
        .filter("kind = k AND canon = c")
        .select("tkey", F.struct("at", worn(F.col("kind"), F.col("mention"), F.col("fake")).alias("new")).alias("m"))
        .groupBy("tkey").agg(F.map_from_entries(F.collect_list("m")).alias("new"))
    )
    text = F.array_join(F.transform("gaps", lambda g, i: F.concat(F.when(i > 0, F.coalesce(F.col("new")[i - 1], F.get("old", i - 1))).otherwise(F.lit("")), g)), "")
    done = written(parts.join(new, "tkey").select("tkey", text.alias("new_text"), F.size(F.map_keys("new")).cast("long").alias("n")), "replaced")
    put = salted_join(base, done, "tkey", "row.doc_id" if "doc_id" in columns else "row", "left").select(
        *[F.coalesce("new_text", "row.text").alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in columns], F.coalesce("n", F.lit(0).cast("long")).alias("n_entities")
    )
    return put.unionByName(rest)

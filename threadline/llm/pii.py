"""Surrogates for personal data (DataFrame functions only).

Each entity found in a text (e-mail, phone, payment card, IPv4, social security
number, IBAN, access key, person after a title) is replaced by a keyed surrogate
of the same kind: same layout, letter case, script, gender of the title, valid
check digits.  The same entity gets the same surrogate everywhere (coreference),
and different entities different ones: candidates that collide with each other
or with an entity of the corpus are drawn again with the next attempt number.
The domains of e-mail addresses are entities too, so that different ones stay
different.  A phone number of the +1 zone is the same entity with and without it.
Persons are found after titles.  Their given names and their surname are entities of
their own, whatever the title and its full stop, so ``Mrs. Anna Smith``, ``Mrs Smith`` and
``Dr. Smith`` keep one surname; where a text has a titled full name, the same name without a
title is replaced in that text too (it is not counted in ``pii`` again).  A title without a gender
leaves it to the ending of the given name.  Initials and particles (van, de ...) are no entities.

Defined results: null text stays null and an empty text empty, both without
entities; runs of 13 to 19 digits without a valid check digit are left alone;
repeated rows get equal results; extra columns are kept whatever their names (where
docs has a column ``pii`` the array is named with underscores after it).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import boxed, stored
from .quality import let

# Titles by gender, and given names by script and gender.
MALE = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "господин", "κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "госпожа", "κυρία")
NEUTRAL = ("Dr", "Prof", "Professor", "Doctor", "Doktor")
PARTICLES = ("van", "von", "de", "der", "den", "di", "da", "du", "del", "la", "le", "dos", "bin", "ten", "ter", "zu")
GIVEN = {
    ("latin", "m"): ("Adam", "Bruno", "Carl", "David", "Emil", "Felix", "Hugo", "Ivan", "Jonas", "Leo", "Marco", "Noel", "Oscar", "Paul", "Simon", "Tom"),
    ("latin", "f"): ("Ada", "Bella", "Clara", "Diana", "Emma", "Flora", "Greta", "Helen", "Irma", "Julia", "Laura", "Marta", "Nora", "Olga", "Paula", "Rosa"),
    ("cyrillic", "m"): ("Антон", "Борис", "Вадим", "Глеб", "Денис", "Егор", "Иван", "Кирилл", "Лев", "Максим", "Никита", "Олег", "Павел", "Роман", "Семён", "Тимур"),
    ("cyrillic", "f"): ("Анна", "Белла", "Вера", "Галина", "Дарья", "Ева", "Жанна", "Зоя", "Ирина", "Кира", "Лидия", "Майя", "Нина", "Ольга", "Полина", "Раиса"),
    ("greek", "m"): ("Άρης", "Βασίλης", "Γιώργος", "Δήμος", "Ερμής", "Ηλίας", "Θάνος", "Ιάσονας", "Κώστας", "Λουκάς", "Μάρκος", "Νίκος", "Πέτρος", "Σταύρος", "Τάσος", "Φώτης"),
    ("greek", "f"): ("Άννα", "Βίκυ", "Γιάννα", "Δήμητρα", "Ελένη", "Ζωή", "Ηρώ", "Θάλεια", "Ιωάννα", "Κατερίνα", "Λυδία", "Μαρία", "Νίκη", "Ξένια", "Σοφία", "Χαρά"),
}
SYLLABLES = {
    "latin": ("ba", "den", "gor", "hal", "ker", "lin", "mar", "nes", "por", "ral", "sen", "tor", "ven", "wal", "zim", "fel"),
    "cyrillic": ("ба", "ден", "гор", "хал", "кер", "лин", "мар", "нес", "пор", "рал", "сен", "тор", "вен", "вал", "зим", "фел"),
    "greek": ("βα", "δεν", "γορ", "χαλ", "κερ", "λιν", "μαρ", "νες", "πορ", "ραλ", "σεν", "τορ", "βεν", "βαλ", "ζιμ", "φελ"),
}
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: A part of a name: inner capitals, apostrophes and hyphens, or an initial before another part.
_WORD = r"(?:\p{Lu}\.(?= \p{Lu})|\p{Lu}\p{L}*+(?:['’-]\p{L}\p{L}++)*+)"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._+-])[\p{L}\p{N}][\p{L}\p{N}._+-]*+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+",
    "iban": r"\b[A-Z]{2}\d{2}(?:(?=[A-Z0-9]*\d)[A-Z0-9]{11,30}| [A-Z0-9]{4}(?: (?=[A-Z]*\d)[A-Z0-9]{4}){1,6}(?: (?=[A-Z]*\d)[A-Z0-9]{1,3})?)\b",
    "key": r"(?:\b(?:AKIA|ASIA)[A-Z0-9]{16}\b|\bgh[pousr]_[A-Za-z0-9]{36}\b|\bsk-[A-Za-z0-9_-]{20,}+|\beyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]++\.[A-Za-z0-9_-]++|(?<![0-9A-Za-z])(?=[0-9A-Fa-f]*[A-Fa-f])[0-9A-Fa-f]{32,64}(?![0-9A-Za-z])|(?<=\b(?i:password|passwd|secret|api_key|token)(?:=|: ?(?=[^\s\"',;&]{0,99}\d)))([^\s\"',;&]{6,}+))",
    "phone": r"(?:\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)|\+(?=[1-9](?:[ .()-]{0,3}\d){7})\d{1,3}[ .-]?(?:\(0\)[ .-]?)?\(?\d{1,4}\)?(?:[ .-]?\d{2,4}){1,4}(?!\d)|(?<![\d-])\(?\d{3}\)?[ .-]\d{3}-\d{4}(?![\d-])|(?<![\d.-])\d{3}\.\d{3}\.\d{4}(?![\d-]|\.\d))",
    "card": r"(?<![\d.])(?:\d{13,19}|\d{4}(?<by>[ -])\d{4}\k<by>\d{4}\k<by>\d{1,7}|\d{4}(?<of>[ -])\d{6}\k<of>\d{4,5})(?![\d])",
    "ip": rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\d|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "name": rf"\b(?:(?:{'|'.join(MALE + FEMALE + NEUTRAL)})\.? ){{1,3}}{_WORD}(?: (?:(?:{'|'.join(PARTICLES)}) ){{0,2}}{_WORD}){{0,2}}",
}
ANY = "|".join(PATTERNS[k] for k in PATTERNS)
#: The group of ANY that holds a secret after its name, and what comes before one.
SECRET, NAMES = 1, r"(?i:password|passwd|secret|api_key|token)[=:]"
DIGIT_KINDS = ("phone", "card", "ssn")


def kind_of(surface: Column) -> Column:
    """The first pattern that covers the whole surface; a card needs its check digit and an issuer's first digit."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        hit = surface.rlike(f"^(?:{pattern})$") if kind != "card" else surface.rlike(r"^[2-6][\d -]{11,}\d$") & F.call_function("luhn_check", F.regexp_replace(surface, "[ -]", ""))
        out = F.when(hit, F.lit(kind)).otherwise(out)
    return out


def norm_of(kind: Column, surface: Column) -> Column:
    """What must be equal for two surfaces to be one entity."""
    return (
        F.when(kind == "phone", F.regexp_replace(F.regexp_replace(surface, r"\D", ""), r"^1(?=\d{10}$)", ""))
        .when(kind.isin(*DIGIT_KINDS), F.regexp_replace(surface, r"\D", ""))
        .when(kind == "email", F.lower(surface))
        .when(kind == "iban", F.replace(surface, F.lit(" "), F.lit("")))
        .when(kind == "name", let(F.regexp_extract(surface, NAME, 1), lambda titles: F.concat(gender_of(titles), F.lit("|"), F.substr(surface, F.length(titles) + 1))))
        .otherwise(surface)
    )


#: The titles before a name.
NAME = rf"^((?:(?:{'|'.join(MALE + FEMALE + NEUTRAL)})\.? )+)"


def gender_of(titles: Column) -> Column:
    """m, f or n by the titles."""
    words = F.split(F.replace(titles, F.lit("."), F.lit("")), " ")
    return F.when(F.arrays_overlap(words, _list(MALE)), "m").when(F.arrays_overlap(words, _list(FEMALE)), "f").otherwise("n")


def parts_of(norm: Column) -> Column:
    """The words of a name whose norm is gender|words, as (kind, norm, word); kind is null for initials and particles."""

    def part(words):
        def one(w, i):
            last = i == F.size(words) - 1
            gender = F.substring(norm, 1, 1)
            # without a title that tells, by the ending
            known = F.when(gender != "n", gender).otherwise(F.when(w.rlike("[aаяαη]$"), "f").otherwise("m"))
            kind = F.when(w.rlike(r"^\p{Lu}(?!\.)"), F.when(last, "surname").otherwise("given"))
            return F.struct(kind.alias("kind"), F.when(last, F.lower(w)).otherwise(F.concat(known, F.lit("|"), F.lower(w))).alias("norm"), w.alias("word"))

        return F.transform(words, one)

    return let(F.split(F.substr(norm, F.lit(3)), " "), part)


def single(e: Column) -> Column:
    """The entities (kind, norm) behind one found: the parts of a name, else itself."""
    parts = F.transform(F.filter(parts_of(e["norm"]), lambda p: p["kind"].isNotNull()), lambda p: F.struct(p["kind"].alias("kind"), p["norm"].alias("norm")))
    return F.when(e["kind"] == "name", parts).otherwise(F.array(F.struct(e["kind"].alias("kind"), e["norm"].alias("norm"))))


def entity(match: Column) -> Column:
    """A secret after its name is a key whatever its characters; other surfaces tell their kind."""
    surface = match["surface"]
    return let(F.when(match["secret"], F.lit("key")).otherwise(kind_of(surface)), lambda k: F.struct(k.alias("kind"), norm_of(k, surface).alias("norm"), surface.alias("surface")))


def maybe(text: Column) -> Column:
    """Whether a text can hold an entity at all: a cheap test before the patterns.

    Every entity has a digit, an at sign, a title, the name of a secret or the beginning of a key.
    """
    out = text.rlike("[0-9@]")
    short = {"Mrs": "Mr", "Señora": "Señor", "Sra": "Sr", "Professor": "Prof"}
    for part in sorted({"sk-", "eyJ", "AKIA", "ASIA", *(f"gh{c}_" for c in "pousr"), *(short.get(t, t) for t in MALE + FEMALE + NEUTRAL)}):
        out = out | text.contains(part)
    return out | text.rlike(NAMES)


def found(text: Column) -> Column:
    """Array of (surface, secret) in text order; secret: the surface stands after a secret's name."""
    matches = lambda group: F.regexp_extract_all(text, F.lit(ANY), F.lit(group))
    named = text.rlike(NAMES)
    pair = lambda surface, secret: F.struct(surface.alias("surface"), secret.alias("secret"))
    return (
        F.when(maybe(text) & named, F.zip_with(matches(0), matches(SECRET), lambda m, g: pair(m, g != "")))
        .when(maybe(text), F.transform(matches(0), lambda m: pair(m, F.lit(False))))
        .otherwise(F.array().cast("array<struct<surface:string,secret:boolean>>"))
    )


def _list(values) -> Column:
    """A constant array, as one text that is split: a small plan."""
    return F.split(F.lit(" ".join(values)), " ")


def _nibble(hashed: Column, i: Column) -> Column:
    return F.conv(F.substring(hashed, i % 64 + 1, F.lit(1)), 16, 10).cast("int")


def _letters(text: Column, hashed: Column) -> Column:
    """Every letter by one of its script and case, every digit by a digit; other characters stay."""

    def one(c, i):
        n = _nibble(hashed, i)
        return (
            F.when(c.rlike(r"\d"), (n % 10).cast("string"))
            .when(c.rlike(r"\p{IsCyrillic}"), F.substring(F.lit("бвгджзклмнпрстфх"), n + 1, F.lit(1)))
            .when(c.rlike(r"\p{IsGreek}"), F.substring(F.lit("βγδζθκλμνξπρστφχ"), n + 1, F.lit(1)))
            .when(c.rlike(r"\p{L}"), F.substring(F.lit("bcdfghjkmnprstvz"), n + 1, F.lit(1)))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _hex(text: Column, hashed: Column) -> Column:
    return F.substring(F.concat(hashed, F.sha2(hashed, 256)), F.lit(1), F.length(text))


def _check_digit(payload: Column) -> Column:
    def add(total, c, i):
        v = c.cast("int") * F.when((F.length(payload) - i) % 2 == 1, 2).otherwise(1)
        return total + F.when(v > 9, v - 9).otherwise(v)

    digits = F.transform(F.split(payload, ""), lambda c, i: F.struct(c.alias("c"), i.alias("i")))
    total = F.aggregate(digits, F.lit(0), lambda t, x: add(t, x["c"], x["i"]))
    return ((10 - total % 10) % 10).cast("string")


def _more(attempt: Column, hashed: Column, parts) -> Column:
    """Nothing at first; from the fourth redraw on one more of 16 parts each time, so the space outgrows any corpus."""
    again = F.sha2(hashed, 256)
    each = F.transform(F.sequence(F.lit(0), F.least(attempt - 4, F.lit(63))), lambda i: F.element_at(_list(parts), _nibble(again, i) + 1))
    return F.when(attempt > 3, F.array_join(each, "")).otherwise(F.lit(""))


def _in_script(word: Column, build) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), build("cyrillic")).when(word.rlike(r"\p{IsGreek}"), build("greek")).otherwise(build("latin"))


def _pick(values, hashed: Column, i: int) -> Column:
    return F.element_at(_list(values), _nibble(hashed, F.lit(i)) + 1)


def _surname(norm: Column, hashed: Column, attempt: Column) -> Column:
    return _in_script(norm, lambda s: F.concat(*[_pick(SYLLABLES[s], hashed, i) for i in (1, 2, 3, 4)], _more(attempt, hashed, SYLLABLES[s])))


def _given(norm: Column, hashed: Column, attempt: Column) -> Column:
    """gender|name: one of 16 at first, with one more syllable for each redraw."""
    gender = F.substring(norm, 1, 1)

    def build(s):
        first = F.when(gender == "m", _pick(GIVEN[s, "m"], hashed, 0)).otherwise(_pick(GIVEN[s, "f"], hashed, 0))
        return F.concat(gender, F.lit("|"), F.lower(first), _more(attempt + 3, hashed, SYLLABLES[s]))

    return _in_script(norm, build)


def _check_mod_97(country: Column, account: Column) -> Column:
    """The two check digits of an IBAN."""

    def add(total, c):
        # letters count from 10
        v = F.when(c.rlike(r"\d"), c.cast("int")).otherwise(F.ascii(c) - 55)
        return (total * F.when(v > 9, 100).otherwise(10) + v) % 97

    rest = F.aggregate(F.split(F.concat(account, country, F.lit("00")), ""), F.lit(0), add)
    return F.lpad((98 - rest).cast("string"), 2, "0")


def domain_of(email: Column) -> Column:
    """What stands between the at sign and the last full stop."""
    return F.regexp_extract(email, r"@(.*)\.[^.]*$", 1)


def _hashed(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\u0001", F.lit(key), *parts), 256)


def domain_surrogate(name: Column, attempt: Column, key: str) -> Column:
    h = _hashed(key, F.lit("domain"), name, attempt.cast("string"))
    return F.concat(_letters(name, h), _more(attempt, h, "bcdfghjkmnprstvz"))


def surrogate(kind: Column, norm: Column, attempt: Column, of_domain: Column, key: str) -> Column:
    """The candidate that stands for (kind, norm); of_domain: the attempt of an e-mail's domain."""

    def build(h):
        digits = F.translate(h, "abcdef", "012345")
        n = F.length(norm)
        payload = F.concat(F.substring(norm, 1, 1), F.substring(digits, F.lit(2), n - 2))
        local = F.regexp_extract(norm, "^(.*)@", 1)
        more = lambda h: _more(attempt, h, "bcdfghjkmnprstvz")

        return (
            F.when(kind == "email", F.concat(_letters(local, h), more(h), F.lit("@"), domain_surrogate(domain_of(norm), of_domain, key), F.regexp_extract(norm, r"(\.[^.]*)$", 1)))
            # a phone keeps what stands before its last ten digits
            .when(kind == "phone", F.concat(F.substring(norm, F.lit(1), F.greatest(n - 10, F.lit(0))), F.substring(digits, F.lit(1), F.least(n, F.lit(10)))))
            .when(kind == "card", F.concat(payload, _check_digit(payload)))
            .when(kind == "ip", F.array_join(F.transform(F.array(*map(F.lit, (1, 3, 5, 7))), lambda i: (F.conv(F.substring(h, i, F.lit(2)), 16, 10).cast("int") % 254 + 1).cast("string")), "."))
            .when(kind == "ssn", F.concat(F.lit("9"), F.substring(digits, 2, 8)))
            .when((kind == "key") & norm.rlike("^[0-9]+$"), F.concat(F.array_join(F.transform(F.split(norm, ""), lambda c, i: (_nibble(h, i) % 10).cast("string")), ""), more(h)))
            .when((kind == "key") & norm.rlike("^[0-9a-f]+$"), F.concat(_hex(norm, h), more(h)))
            .when((kind == "key") & norm.rlike("^[0-9A-F]+$"), F.concat(F.upper(_hex(norm, h)), more(h)))
            .when(kind == "key", let(F.regexp_extract(norm, "^(AKIA|ASIA|gh[pousr]_|sk-|eyJ)?(.*)$", 2), lambda r: F.concat(F.substring(norm, F.lit(1), n - F.length(r)), _cased(r, _letters(r, h)), more(h))))
            .when(kind == "iban", let(F.upper(_letters(F.substring(norm, F.lit(5), n), h)), lambda x: F.concat(F.substring(norm, 1, 2), _check_mod_97(F.substring(norm, 1, 2), x), x)))
            .when(kind == "given", _given(norm, h, attempt))
            .otherwise(_surname(norm, h, attempt))
        )

    return let(_hashed(key, kind, norm, attempt.cast("string")), build)


def _cased(model: Column, text: Column) -> Column:
    """text with the letter case of model, position by position."""
    return F.array_join(F.zip_with(F.split(model, ""), F.split(text, ""), lambda a, b: F.when(a.rlike(r"\p{Lu}"), F.upper(b)).otherwise(b)), "")


def rendered(kind: Column, surface: Column, value: Column) -> Column:
    """The surrogate in the layout of this surface; a phone's zone stays as it is."""
    digits = F.regexp_replace(surface, r"\D", "")
    value = F.when(kind == "phone", F.concat(F.substring(digits, F.lit(1), F.greatest(F.length(digits) - F.length(value), F.lit(0))), value)).otherwise(value)

    def step(acc, c):
        digit = F.when(kind == "iban", c != " ").otherwise(c.rlike(r"\d"))
        return F.struct(
            F.concat(acc["out"], F.when(digit, F.substring(value, acc["n"] + 1, F.lit(1))).otherwise(c)).alias("out"),
            (acc["n"] + F.when(digit, 1).otherwise(0)).alias("n"),
        )

    laid = F.aggregate(F.split(surface, ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("n")), step, lambda a: a["out"])
    return (
        F.when(kind.isin(*DIGIT_KINDS, "iban"), laid)
        .when((kind == "email") & (F.length(surface) == F.length(value)), _cased(surface, value))
        .otherwise(value)
    )


def _drawn(entities: DataFrame, value: Column, stuck: int) -> DataFrame:
    """(kind, norm, attempt) of those entities (kind, norm, of_domain) whose first candidate (value, of these and attempt) collided."""
    now = entities.select("kind", "norm", "of_domain", F.lit(0).alias("attempt"))
    least, since = None, 0
    while True:
        drawn = stored(now.withColumn("value", value), "surrogates")
        # an earlier attempt keeps its value before a later one takes it
        first = drawn.groupBy("kind", "value").agg(F.min(F.struct("attempt", "norm")).alias("first"), F.count("*").alias("n")).where("n > 1")
        lost = drawn.join(first, ["kind", "value"]).where((F.col("first.norm") != F.col("norm"))).select("kind", "norm")
        real = drawn.join(entities.select("kind", F.col("norm").alias("value")), ["kind", "value"]).select("kind", "norm")
        losers = stored(lost.union(real).distinct().withColumn("lost", F.lit(1)), "losers")
        n = losers.count()
        if n == 0:
            return drawn.where("attempt > 0").select("kind", "norm", "attempt")
        now = drawn.join(losers, ["kind", "norm"], "left").select("kind", "norm", "of_domain", (F.col("attempt") + F.coalesce("lost", F.lit(0))).alias("attempt"))
        least, since = (n, 0) if least is None or n < least else (least, since + 1)
        if since >= stuck:
            raise ValueError(f"{n} entities find no free surrogate in their layout")


def assigned(entities: DataFrame, key: str, stuck: int = 32) -> DataFrame:
    """(kind, norm, attempt) of the distinct entities, and domains, whose first candidate collided.

    A candidate loses if a smaller norm of its kind has the same one or if it is
    itself an entity of the corpus; losers draw again until none is left.  The
    space of e-mails, domains, keys and names grows with the attempt, so that ends;
    the other kinds have fixed layouts, and ``stuck`` rounds without fewer losers
    mean that one of them is full.
    """
    mail = F.col("kind") == "email"
    domains = entities.where(mail).select(F.lit("domain").alias("kind"), domain_of(F.col("norm")).alias("norm"), F.lit(0).alias("of_domain")).distinct()
    redrawn = stored(_drawn(domains, domain_surrogate(F.col("norm"), F.col("attempt"), key), stuck), "domains")
    known = redrawn.select(F.col("norm").alias("d"), F.col("attempt").alias("of_domain"))
    rows = entities.join(known, mail & (domain_of(F.col("norm")) == F.col("d")), "left").select("kind", "norm", F.coalesce("of_domain", F.lit(0)).alias("of_domain"))
    value = surrogate(F.col("kind"), F.col("norm"), F.col("attempt"), F.col("of_domain"), key)
    return _drawn(rows, value, stuck).unionByName(redrawn)


def replace(docs: DataFrame, key: str = "threadline", small: int = 2000) -> DataFrame:
    """docs with the entities of ``text`` replaced, and ``pii`` = array of (kind, surrogate) in text order.

    Attempt numbers of the few entities whose first candidate collided are sent
    to every task when there are at most ``small`` of them, else joined by entity.
    """
    each = docs.select(F.explode(found(F.col("text"))).alias("m")).select(entity(F.col("m")).alias("e")).where("e.kind IS NOT NULL").select(F.explode(single(F.col("e"))).alias("e")).select("e.kind", "e.norm")
    redrawn = stored(assigned(stored(each.distinct(), "entities"), key), "redrawn")
    id_of = lambda kind, norm: F.concat(kind, F.lit("\u0001"), norm)
    domain_id = lambda e: F.when(e["kind"] == "email", id_of(F.lit("domain"), domain_of(e["norm"])))
    table = redrawn.select(id_of(F.col("kind"), F.col("norm")).alias("id"), "attempt")
    others = [c for c in docs.columns if c != "text"]
    carried, box = boxed(docs, others)
    rows = carried.withColumn("found", F.transform(found(F.col("text")), entity))
    if redrawn.limit(small + 1).count() <= small:
        taken = table.agg(F.map_from_entries(F.collect_list(F.struct("id", "attempt"))).alias("attempts"))
        rows = rows.crossJoin(F.broadcast(taken))  # one row of at most `small` entries
    else:
        rows = stored(rows.withColumn("row", F.expr("uuid()")), "found")
        ids = F.concat(F.flatten(F.transform(F.filter("found", lambda e: e["kind"].isNotNull()), lambda e: F.transform(single(e), lambda x: id_of(x["kind"], x["norm"])))), F.transform("found", domain_id))
        of_row = (
            rows.select("row", F.explode(F.array_distinct(F.array_compact(ids))).alias("id"))
            .join(table, "id")
            .groupBy("row")
            .agg(F.map_from_entries(F.collect_list(F.struct("id", "attempt"))).alias("attempts"))
        )
        rows = rows.join(of_row, "row", "left")

    taken = lambda x: F.coalesce(F.try_element_at(F.col("attempts"), x), F.lit(0))

    def part(p):
        """A word of a name: initials take the letter of a given name, particles stay."""
        value = F.regexp_replace(surrogate(p["kind"], p["norm"], taken(id_of(p["kind"], p["norm"])), F.lit(0), key), r"^[mf]\|", "")
        shown = F.when((F.upper(p["word"]) == p["word"]) & (F.length(p["word"]) > 1), F.upper(value)).otherwise(F.initcap(value))
        initial = F.concat(F.upper(F.substring(_letters(F.substring(p["word"], 1, 1), _hashed(key, F.lit("initial"), p["word"])), 1, 1)), F.lit("."))
        return F.when(p["kind"].isNotNull(), shown).when(p["word"].endswith("."), initial).otherwise(p["word"])

    def final(e):
        name = F.array_join(F.transform(parts_of(e["norm"]), part), " ")
        other = let(surrogate(e["kind"], e["norm"], taken(id_of(e["kind"], e["norm"])), taken(domain_id(e)), key), lambda v: rendered(e["kind"], e["surface"], v))
        titled = F.concat(F.regexp_extract(e["surface"], NAME, 1), name)
        return F.struct(e["kind"].alias("kind"), F.when(e["kind"].isNull(), e["surface"]).when(e["kind"] == "name", titled).otherwise(other).alias("surrogate"))

    rows = rows.withColumn("new", F.when(F.size("found") > 0, F.transform("found", final)))
    own = lambda x: F.regexp_replace(x, NAME, "")
    # full names that stand after a title, longest first, and what they become
    pairs = F.filter(F.zip_with("found", "new", lambda e, x: F.when(e["kind"] == "name", F.struct(own(e["surface"]).alias("name"), own(x["surrogate"]).alias("value")))), lambda x: x["name"].contains(" "))
    rows = rows.withColumn("bare", F.reverse(F.array_sort(F.array_distinct(pairs))))

    def without_titles(gap):
        return F.aggregate("bare", gap, lambda t, x: F.regexp_replace(t, F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), x["name"], F.lit(r"\E(?![\p{L}\p{N}])")), x["value"]))

    cut = F.split("text", ANY, -1)
    gaps = F.when(F.size("bare") > 0, F.transform(cut, without_titles)).otherwise(cut)
    text = F.concat(F.array_join(F.zip_with(F.slice(gaps, 1, F.size("new")), F.col("new.surrogate"), lambda a, b: F.concat(a, b)), ""), F.element_at(gaps, -1))
    name = "pii"
    while name in docs.columns:
        name += "_"
    return rows.select(
        *[(F.when(F.col("new").isNull(), F.col("text")).otherwise(text).alias("text") if c == "text" else F.col(box)[c].alias(c)) for c in docs.columns],
        F.coalesce(F.filter("new", lambda e: e["kind"].isNotNull()), F.array().cast("array<struct<kind:string,surrogate:string>>")).alias(name),
    )


def count_of(kind: str) -> Column:
    """How many entities of a kind ``pii`` holds."""
    return F.size(F.filter("pii", lambda e: e["kind"] == kind)).cast("long")

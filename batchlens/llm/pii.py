"""Personal data and secrets in texts, replaced by keyed stand-ins of their kind."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from batchlens.llm.tables import written

# What counts as an entity, in the order in which patterns are tried.
TITLES = {
    "m": "Mr|Mister|Herr|Monsieur|Señor|Don|г-н|господин",
    "f": "Mrs|Ms|Miss|Madam|Frau|Madame|Mme|Señora|Doña|г-жа|госпожа",
    "n": "Dr|Prof",
}
_TITLE = "|".join(TITLES.values())
_NAME = r"\p{Lu}[\p{Ll}'’]+(?:-\p{Lu}\p{Ll}+)?"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "key": r"\bAKIA[0-9A-Z]{16}\b",
    "secret": r"(?<=(?i:password)[=:])[^\s\"',;]+|(?<=(?i:token) = \")[^\"\s]+|(?<=(?i:token)=)[^\s\"',;]+"
    r"|\b[0-9a-fA-F]{32,}\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[0-9A-Z]{4}){3,7}(?: ?[0-9A-Z]{1,3})?\b",
    "ip": r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d)",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\)\s?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\d)",
    "card": r"(?<![\d.-])\d(?:[ -]?\d){12,18}(?![\d-])",
    "national": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "name": rf"\b(?:{_TITLE})\.? {_NAME}(?: {_NAME}){{0,2}}",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# Every entity holds a character of the first set, or starts with a title.
MAY_HOLD = rf"[0-9@=:]|(?i:password|token)|[a-fA-F]{{32}}|(?:{_TITLE})\.? \p{{Lu}}"
GIVEN = {
    ("latin", "m"): "Adam Bruno Carl Daniel Edgar Felix Georg Hugo Ivan Jonas Karl Leon Martin Nils Oscar Paul",
    ("latin", "f"): "Anna Berta Clara Diana Elena Flora Greta Helga Irene Julia Karla Laura Maria Nora Olga Paula",
    ("latin", "n"): "Alex Andrea Charlie Dana Eden Jamie Kim Morgan Noa Pat Quinn Robin Sam Sascha Toni Uli",
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Марк Олег Павел Роман Семён Тимур Юрий",
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Инна Клара Лидия Мария Нина Ольга Полина Раиса Софья",
    ("cyrillic", "n"): "Саша Женя Валя Шура Слава Паша Вася Тоня Сима Ника Мика Ира Лёня Миша Гена Люся",
}
# Parts of made-up family names.
SYLLABLES = {
    "latin": "ba ber da del fa gor han ka kel la lin ma mer na nor pa rel ro sa sel ta tor va vel",
    "cyrillic": "ба бер да дел фа гор хан ка кел ла лин ма мер на нор па рел ро са сел та тор ва вел",
}
# Draws of the entity's own form before longer forms, which cannot run out.
SAME_FORM = 6


def mentions_in(text: Column) -> Column:
    """All mentions of entities, from left to right; none in NULL."""
    return F.when(
        text.rlike(MAY_HOLD), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    ).otherwise(F.array().cast("array<string>"))


def _kind(mention: Column) -> Column:
    whole = lambda name: mention.rlike(f"^(?:{PATTERNS[name]})$")
    cases = F.when(whole("email"), "email")
    for name in ("key", "iban", "ip", "phone", "card", "national", "name"):
        cases = cases.when(whole(name), name)
    # Short ones in capitals may be passwords, in which case tells.
    return cases.when(mention.rlike("^(?:[0-9a-f]+|[0-9a-fA-F]{32,})$"), "hex").otherwise("secret")


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")


def _entity(kind: str, entity: Column, gender: Column | None = None) -> Column:
    """What is looked up: one per entity, however its mentions are written."""
    return F.struct(
        F.lit(kind).alias("kind") if isinstance(kind, str) else kind.alias("kind"),
        entity.alias("entity"),
        (F.lit("") if gender is None else gender).alias("gender"),
    )


def _entities(mention: Column, kind: Column) -> Column:
    """The entities of a mention: one, or the parts of a name."""
    digits = F.regexp_replace(mention, r"\D", "")
    canonical = (
        F.when(kind.isin("email", "hex"), F.lower(mention))
        .when(kind == "phone", F.substring(digits, -10, 10))
        .when(kind.isin("card", "national"), digits)
        .when(kind == "iban", F.regexp_replace(mention, " ", ""))
        .otherwise(mention)
    )
    parts = F.slice(F.split(mention, " "), 2, 3)
    listed = lambda sex: F.array(
        *[F.lit(n) for (_, s), names in GIVEN.items() if s == sex for n in names.split()]
    )
    first = F.get(parts, F.lit(0))
    told = lambda sex: mention.rlike(f"^(?:{TITLES[sex]})[. ]")
    gender = (
        F.when(told("f"), "f")
        .when(told("m"), "m")
        .when(F.array_contains(listed("f"), first), "f")
        .when(F.array_contains(listed("m"), first), "m")
        .otherwise("n")
    )
    named = F.transform(
        parts,
        lambda part, i: F.when(i == F.size(parts) - 1, _entity("family", part)).otherwise(
            _entity("given", part, gender)
        ),
    )
    return F.when(kind == "name", named).otherwise(F.array(_entity(kind, canonical)))


def _drawn(source: Column, digest: Column) -> Column:
    """Every digit, capital and small letter drawn anew by the digest and its place."""

    def letter(value: Column, first: str) -> Column:
        return F.char(F.pmod(value, F.lit(26)) + F.lit(ord(first)))

    def pick(c: Column, i: Column) -> Column:
        value = F.xxhash64(digest, i)
        return (
            F.when(c.rlike("[0-9]"), F.pmod(value, F.lit(10)).cast("string"))
            .when(c.rlike("[a-z]"), letter(value, "a"))
            .when(c.rlike("[A-Z]"), letter(value, "A"))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.split(source, ""), pick), "")


def _luhn_sum(digits: Column) -> Column:
    def add(total: Column, c: Column) -> Column:
        # at: counted from the right, every second digit is doubled
        value = c.cast("int") * F.when(total["at"] % 2 == 1, 2).otherwise(1)
        return F.struct(
            (total["at"] + 1).alias("at"),
            (total["sum"] + F.when(value > 9, value - 9).otherwise(value)).alias("sum"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("sum"))
    each = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    return F.aggregate(each, start, add, lambda s: s["sum"])


def _card(entity: Column, drawn: Column, longer: Column) -> Column:
    """First digit kept; a valid check digit where the number had one."""
    number = F.concat(F.substring(entity, 1, 1), F.substr(drawn, F.lit(2)), F.translate(longer, LOWER_HEX, "012345"))
    body = F.substr(number, F.lit(1), F.length(number) - 1)
    check = F.pmod(F.lit(10) - _luhn_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10))
    return F.when(_luhn_sum(entity) % 10 == 0, F.concat(body, check.cast("string"))).otherwise(number)


LOWER_HEX = "abcdef"


def _listed(names: str, digest: Column, count: Column, joiner: str) -> Column:
    words = F.array(*[F.lit(n) for n in names.split()])
    at = lambda i: F.pmod(F.xxhash64(digest, i), F.lit(len(names.split()))).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(1), count), lambda i: F.get(words, at(i))), joiner)


def _surrogate(secret: str) -> Column:
    """From ``kind``, ``entity``, ``gender`` and ``attempt``."""
    kind, entity, attempt = F.col("kind"), F.col("entity"), F.col("attempt")
    digest = F.sha2(F.concat_ws("|", F.lit(secret), "kind", "gender", attempt.cast("string"), "entity"), 256)
    longer = F.substr(digest, F.lit(1), F.greatest(attempt - SAME_FORM + 1, F.lit(0)))
    more_digits = F.translate(longer, LOWER_HEX, "012345")
    drawn = _drawn(entity, digest)
    domain = F.substring_index(entity, "@", -1)
    ending = F.regexp_extract(domain, r"\.(com|net|org)$", 1)
    domain_digest = F.sha2(F.concat_ws("|", F.lit(secret), F.lit("domain"), domain), 256)
    # Domains set aside for examples belong to nobody.
    email = F.concat(
        F.substring_index(drawn, "@", 1), longer, F.lit("@m"), F.substring(domain_digest, 1, 6),
        F.lit(".example."), F.when(ending == "", "com").otherwise(ending),
    )
    octet = lambda i: F.pmod(F.xxhash64(digest, F.lit(i)), F.lit(256)).cast("string")
    network = F.when(attempt < SAME_FORM, "10").otherwise(
        (F.pmod(F.xxhash64(digest), F.lit(15)) + 240).cast("string")
    )
    phone = F.concat(F.translate(F.substring(drawn, 1, 1), "01", "23"), F.substr(drawn, F.lit(2)), more_digits)
    hexes = F.concat(digest, F.sha2(digest, 256), F.sha2(F.concat(digest, digest), 256))
    hexed = F.array_join(
        F.transform(
            F.sequence(F.lit(0), F.length(entity) - 1),
            lambda i: F.substr(hexes, F.pmod(i, F.lit(192)) + 1, F.lit(1)),
        ),
        "",
    )
    given = None
    for (script, sex), names in GIVEN.items():
        here = (_script(entity) == script) & (F.col("gender") == sex)
        name = _listed(names, digest, attempt + 1, "-")
        given = F.when(here, name) if given is None else given.when(here, name)
    family = F.initcap(
        F.when(
            _script(entity) == "cyrillic", _listed(SYLLABLES["cyrillic"], digest, attempt + 4, "")
        ).otherwise(_listed(SYLLABLES["latin"], digest, attempt + 4, ""))
    )
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", F.concat_ws(".", network, octet(1), octet(2), octet(3)))
        .when(kind == "key", F.concat(F.lit("AKIA"), F.substr(drawn, F.lit(5)), F.upper(longer)))
        .when(kind == "card", _card(entity, drawn, longer))
        .when(kind == "phone", phone)
        .when(kind == "national", F.concat(drawn, more_digits))
        .when(kind == "iban", F.concat(F.substring(entity, 1, 2), F.substr(drawn, F.lit(3)), more_digits))
        .when(kind == "hex", F.concat(hexed, longer))
        .when(kind == "given", given)
        .when(kind == "family", family)
        .otherwise(F.concat(drawn, longer))
    )


def surrogates(entities: DataFrame, secret: str) -> DataFrame:
    """``(kind, entity, gender, surrogate)`` for distinct ``(kind, entity, gender)``.

    A surrogate depends on the secret and the entity alone, unless it collides:
    with another entity's surrogate, or with an entity that occurs in the texts.
    Then the later entity is drawn again, until all are distinct; after a few
    draws forms grow longer, so this ends even where a form is exhausted.
    """
    state = entities.withColumn("attempt", F.lit(0))
    while True:
        drawn = state.withColumn("surrogate", _surrogate(secret))
        among = Window.partitionBy("kind", "surrogate").orderBy("attempt", "gender", "entity")
        real = entities.select(F.col("kind").alias("__k"), F.col("entity").alias("__e")).distinct()
        checked = (
            drawn.withColumn("__nth", F.row_number().over(among))
            .join(real, (F.col("kind") == F.col("__k")) & (F.col("surrogate") == F.col("__e")), "left")
            .withColumn("__again", (F.col("__nth") > 1) | F.col("__e").isNotNull())
            .select(*drawn.columns, "__again")
        )
        checked = written(checked, "surrogates")
        if checked.where("__again").isEmpty():
            return checked.select("kind", "entity", "gender", "surrogate")
        state = checked.select(
            "kind", "entity", "gender", (F.col("attempt") + F.col("__again").cast("int")).alias("attempt")
        )


def _filled(mention: Column, surrogate: Column, kept: Column, slot: str) -> Column:
    """``mention`` with its characters in ``slot`` replaced in turn by those of the
    surrogate, after the first ``kept`` of them; what is left over follows."""
    taken = lambda i: F.length(F.regexp_replace(F.substr(mention, F.lit(1), i), f"[^{slot}]", "")) - kept
    filled = F.array_join(
        F.transform(
            F.filter(F.split(mention, ""), lambda c: c != ""),
            lambda c, i: F.when(
                c.rlike(f"[{slot}]") & (taken(i) >= 0), F.substr(surrogate, taken(i) + 1, F.lit(1))
            ).otherwise(c),
        ),
        "",
    )
    return F.concat(filled, F.substr(surrogate, taken(F.length(mention)) + 1))


def _cased(mention: Column, surrogate: Column) -> Column:
    """``surrogate`` in capitals where ``mention`` has no small letter but capitals,
    and where it mixes them at the places of its capitals."""
    place = F.filter(F.split(surrogate, ""), lambda c: c != "")
    mixed = F.array_join(
        F.transform(place, lambda c, i: F.when(F.substr(mention, i + 1, F.lit(1)).rlike("[A-F]"), F.upper(c)).otherwise(c)),
        "",
    )
    return (
        F.when(~mention.rlike("[A-F]"), surrogate).when(~mention.rlike("[a-f]"), F.upper(surrogate)).otherwise(mixed)
    )


def _rendered(kind: Column, mention: Column, parts: Column) -> Column:
    """The surrogate in the format of the mention."""
    first = F.get(parts, F.lit(0))
    digits = F.length(F.regexp_replace(mention, r"\D", ""))
    names = F.concat_ws(" ", F.get(F.split(mention, " "), F.lit(0)), F.array_join(parts, " "))
    return (
        F.when(kind == "phone", _filled(mention, first, digits - 10, "0-9"))
        .when(kind.isin("card", "national"), _filled(mention, first, F.lit(0), "0-9"))
        .when(kind == "iban", _filled(mention, first, F.lit(0), "0-9A-Z"))
        .when(kind == "name", names)
        .when(kind == "hex", _cased(mention, first))
        .otherwise(first)
    )


def pseudonymise(
    df: DataFrame, secret: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``df`` with the entities of ``text`` replaced, and ``n_entities`` added.

    Emails, keys, passwords and tokens, account, card, national and telephone
    numbers, network addresses, and names after a title. One entity gets one
    surrogate in all texts, in the format of each mention (a phone number with
    brackets keeps them, a card its valid check digit, a name its script and
    gender); different entities get different ones. A full name met with a title
    is also replaced where the text repeats it without.

    NULL texts stay NULL, texts without entities stay as they are; repeated rows
    get equal texts; a column ``n_entities`` is replaced. Texts that cannot hold
    an entity are passed through; only the others meet their surrogates in a
    join, by id and hash of the text.
    """
    mark = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    may_hold = F.coalesce(F.col(text).rlike(MAY_HOLD), F.lit(False))
    mentioned = (
        df.where(may_hold)
        .select(F.col(key).alias("__k"), mark.alias("__m"), mentions_in(F.col(text)).alias("__all"))
        .where(F.size("__all") > 0)
        .select("__k", "__m", F.posexplode_outer("__all").alias("__at", "__mention"))
        .withColumn("__kind", _kind(F.col("__mention")))
        .withColumn("__parts", _entities(F.col("__mention"), F.col("__kind")))
        .select("__k", "__m", "__at", "__mention", "__kind", F.posexplode_outer("__parts").alias("__p", "__e"))
        .select("__k", "__m", "__at", "__mention", "__kind", "__p", "__e.*")
    )
    mentioned = written(mentioned, "mentions")
    entities = mentioned.select("kind", "entity", "gender").distinct()
    known = surrogates(entities, secret)
    per_mention = (
        mentioned.join(known, ["kind", "entity", "gender"])
        .groupBy("__k", "__m", "__at", "__mention", "__kind")
        .agg(F.sort_array(F.collect_set(F.struct("__p", "surrogate"))).alias("__s"))
        .withColumn("__parts", F.transform("__s", lambda s: s["surrogate"]))
        .withColumn("__new", _rendered(F.col("__kind"), F.col("__mention"), F.col("__parts")))
    )
    full_name = F.when(
        (F.col("__kind") == "name") & (F.size("__parts") > 1),
        F.struct(
            F.expr("substr(__mention, instr(__mention, ' ') + 1)").alias("old"),
            F.array_join("__parts", " ").alias("new"),
        ),
    )
    per_text = per_mention.groupBy("__k", "__m").agg(
        F.transform(F.sort_array(F.collect_set(F.struct("__at", "__new"))), lambda s: s["__new"]).alias("__new"),
        F.sort_array(F.collect_set(full_name)).alias("__names"),
    )
    pieces = F.split(F.col(text), ANY)
    woven = F.array_join(
        F.zip_with(
            pieces, "__new", lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit("")))
        ),
        "",
    )
    # As whole words: "Paul Li" is no part of "Paul Lincoln".
    whole = lambda old: F.concat(F.lit(r"(?<![\p{L}\p{N}])\Q"), old, F.lit(r"\E(?![\p{L}\p{N}])"))
    named = F.aggregate("__names", woven, lambda t, n: F.regexp_replace(t, whole(n["old"]), n["new"]))
    others = [c for c in df.columns if c != "n_entities"]
    changed = (
        df.where(may_hold)
        .withColumn("__mark", mark)
        .join(per_text, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__mark") == F.col("__m")), "left")
        .withColumn("n_entities", F.coalesce(F.size("__new"), F.lit(0)).cast("long"))
        .withColumn(text, F.when(F.col("__new").isNull(), F.col(text)).otherwise(named))
        .select(*others, F.when(F.col("n_entities") > 0, F.col("n_entities")).otherwise(0).cast("long").alias("n_entities"))
    )
    same = df.where(~may_hold).select(*others, F.lit(0).cast("long").alias("n_entities"))
    return same.unionByName(changed)

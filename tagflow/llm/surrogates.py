"""Personal data: surrogate generation with column functions only.

Detected: e-mail addresses, phone numbers (international, with area code, in pairs or
groups, or 10 digits on end; no ranges of years, no fractions), IPv4 addresses, card
numbers (13 to 19 digits), and names behind a title; in the same text such a name counts
without its title too, whole or one of its parts, and shorter mentions are mentions of
the longest name they fit. An entity's normal form (kind and text; e-mails
in lower case, phones and cards by digits, names by their words) gets one keyed
surrogate everywhere, so mentions of one entity stay mentions of one entity:

* digits are replaced by keyed digits in place, signs and length stay (a card number
  keeps a valid or invalid check digit as it was; a phone keeps its country code and a
  leading 0; an address stays within 1..254);
* an e-mail's local part becomes letters and digits of the same kinds and length, its
  domain a reserved one; names come from lists by gender of the title and by script.

Collision check: two entities of one kind must not share a surrogate, and a surrogate
must not be an entity that occurs. Surrogates of attempt 0 are compared over all
entities; those that collide (all but the smallest entity) draw again with the next
attempt until none collides. From a few attempts on, surrogates grow with the attempt, so
that their supply has no end however many entities there are: names by a part from the
lists, e-mails, phones and cards by digits; an address becomes one of 2001:db8::/32.

Defined cases: null stays null; texts without entities stay as they are; repeated rows
get equal texts; an empty table gives an empty result; columns other than doc_id and
text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tagflow.llm.common import cut, let, text_key

KEY = "surrogates-1"

# Titles by gender.
MALE_TITLES = ("Mr", "Herr", "Monsieur", "Señor", "Sr", "господин")
FEMALE_TITLES = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Señora", "Sra", "госпожа")

# Made-up given and family names by script; the lists only need to be distinct.
GIVEN = {
    ("m", "latin"): "Aldo Bruno Cyril Dario Emil Fabio Georg Hugo Ivan Jonas Karl Leo Marco Nils Oscar Pablo".split(),
    ("f", "latin"): "Alma Bella Clara Dora Elsa Flora Greta Helga Irene Julia Karla Lena Maria Nora Olga Paula".split(),
    ("m", "cyrillic"): "Антон Борис Вадим Глеб Денис Егор Захар Иван Кирилл Лев Марк Никита Олег Павел Роман Семён".split(),
    ("f", "cyrillic"): "Анна Белла Вера Галина Дарья Ева Зоя Инна Клара Лидия Мария Нина Ольга Полина Рая София".split(),
}
FAMILY = {
    "latin": "Adler Becker Costa Duval Ernst Ferrer Grant Holm Iver Jansen Keller Lopez Morel Novak Ortiz Pons".split(),
    "cyrillic": "Громенко Думенко Климчук Лысенко Марченко Назаренко Павленко Савчук Ткачук Шевчук".split(),
}

EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9](?:[A-Za-z0-9.-]*[A-Za-z0-9])?\.[A-Za-z]{2,}"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
IPV4 = rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])"
CARD = r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])"
_BEFORE, _AFTER = r"(?<![0-9A-Za-z+]|[0-9][.,])", r"(?![0-9A-Za-z])"
PHONES = (
    # International: a sign, then 7 to 15 digits with at most two marks between them.
    r"\+1[ .-]?\(?[0-9]{3}\)?[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![ .-]?[0-9])",
    r"\+[0-9](?:[ ./()-]{0,2}[0-9]){6,14}",
    # An area code in brackets or before a slash; pairs; no marks at all.
    r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,5}\)[ .-]?[0-9]{2,8}(?:[ .-][0-9]{2,4}){0,3}",
    r"0[0-9]{1,4} ?/ ?[0-9]{3,9}(?:[ -][0-9]{2,4}){0,3}",
    r"0[0-9](?:[ .-]?[0-9]{2}){4}",
    r"[01]?[0-9]{10}|0[0-9]{8}",
    # Groups; neither a range of years nor a number with a fraction.
    r"(?!(?:1[0-9]|20)[0-9]{2} ?- ?(?:1[0-9]|20)[0-9]{2}(?![0-9]))[0-9]{2,4}[ -][0-9]{3,4}(?:[ .-]?[0-9]{2,4}){0,2}",
    r"[0-9]{2,4}\.[0-9]{3,4}(?:[ .-][0-9]{2,4}){1,2}",
)
PHONE = _BEFORE + "(?:" + "|".join(f"(?:{p}){_AFTER}" for p in PHONES) + ")"
TITLES = "|".join(sorted((*MALE_TITLES, *FEMALE_TITLES), key=len, reverse=True))
NAME = (
    r"(?<![\p{L}])(?:" + TITLES + r")\.? \p{Lu}[\p{L}'-]+(?: \p{Lu}[\p{L}'-]+){0,2}"
)
PATTERN = "|".join(f"(?:{p})" for p in (EMAIL, IPV4, CARD, PHONE, NAME))
HINT = r"@|[0-9]{2}|" + "|".join((*MALE_TITLES, *FEMALE_TITLES))


def kind_of(m: Column) -> Column:
    digits = F.length(F.regexp_replace(m, "[^0-9]", ""))
    return (
        F.when(m.contains("@"), "email").when(m.rlike(r"^\p{L}"), "name").when(m.rlike(f"^{IPV4}$"), "ip")
        .when(m.rlike(f"^{CARD}$") & (digits >= 13), "card").otherwise("phone")
    )


def normal(m: Column, kind: Column) -> Column:
    """What mentions of one entity have in common."""
    return (
        F.when(kind == "email", F.lower(m)).when(kind.isin("card", "phone"), F.regexp_replace(m, "[^0-9+]", ""))
        .when(kind == "name", F.regexp_replace(m, r"\.|'s?$", "")).otherwise(m)
    )


def _bare(name: Column) -> Column:
    """A name without its title, title mark and ending."""
    return F.regexp_replace(name, rf"^(?:{TITLES})\.? |'s?$", "")


def _gender(name: Column) -> Column:
    return F.regexp_extract(name, r"^(\p{L}+)", 1).isin(*MALE_TITLES)


def names_of(text: Column) -> Column:
    """The distinct names behind a title in a text, the longest first."""
    found = F.transform(F.regexp_extract_all(text, F.lit(NAME), F.lit(0)), lambda m: normal(m, F.lit("name")))
    by_size = F.transform(F.array_distinct(found), lambda n: F.struct((-F.length(n)).alias("k"), n.alias("n")))
    return F.transform(F.array_sort(by_size), lambda x: x["n"])


def pattern_of(names: Column) -> Column:
    """The pattern for a text: with names in it, it also takes each of them, whole or a part, without a title."""
    forms = F.flatten(F.transform(names, lambda n: let(_bare(n), lambda b: F.concat(F.array(b), F.split(b, " ")))))
    by_size = F.array_sort(F.transform(F.array_distinct(forms), lambda f: F.struct((-F.length(f)).alias("k"), f.alias("f"))))
    forms = F.transform(F.filter(by_size, lambda x: x["k"] < -1), lambda x: x["f"])
    ends = F.concat(F.lit(PATTERN + r"|(?<![\p{L}'-])(?:"), F.array_join(forms, "|"), F.lit(r")(?![\p{L}-])"))
    return F.when(F.size(forms) > 0, ends).otherwise(F.lit(PATTERN))


def same_name(m: Column, names: Column) -> Column:
    """The entity of a mention: the longest name of its text that holds it (with a title: that ends in it, gender alike)."""
    inside = lambda n: F.concat(F.lit(" "), n, F.lit(" ")).contains(F.concat(F.lit(" "), _bare(m), F.lit(" ")))
    titled = m.rlike(rf"^(?:{TITLES})\.? ")
    return F.get(F.filter(names, lambda n: F.when(titled, n.endswith(F.concat(F.lit(" "), _bare(m))) & (_gender(n) == _gender(m))).otherwise(inside(n))), F.lit(0))


def _draw(key: str, entity: Column, attempt: Column, i, most: int) -> Column:
    """A number in [0, most) fixed by key, entity, attempt and place."""
    at = i if isinstance(i, Column) else F.lit(i)
    word = F.substring(F.sha2(F.concat_ws("|", F.lit(key), entity, attempt.cast("string"), at.cast("string")), 256), 1, 13)
    return F.pmod(F.conv(word, 16, 10).cast("bigint"), F.lit(most))


def _digit(n: Column) -> Column:
    return n.cast("int").cast("string")


def _luhn(digits: Column) -> Column:
    """Sum whose remainder by 10 is 0 for a number with a right check digit."""
    size = F.size(digits)
    doubled = F.transform(
        digits,
        lambda d, i: F.when(F.pmod(size - i, F.lit(2)) == 0, F.pmod(d * 2, F.lit(10)) + F.floor(d / 5).cast("int")).otherwise(d),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d)


def _more(attempt: Column, after: int, body) -> Column:
    """One element for each attempt behind `after`; places from 1000 on."""
    return F.transform(F.slice(F.sequence(F.lit(0), F.greatest(attempt - after, F.lit(0))), 2, 1 << 30), lambda i: body(i + 999))


def _numbers(key: str, entity: Column, attempt: Column, kept: Column) -> Column:
    """Digits (array of int) of the surrogate; the first `kept` ones and a leading 0 stay.

    A length may be used up: from attempt 5 on there is one digit more with each attempt.
    """
    own = F.transform(F.split(F.regexp_replace(entity, "[^0-9]", ""), ""), lambda d: d.cast("int"))
    own = F.filter(own, lambda d: d.isNotNull())
    new = F.transform(
        own,
        lambda d, i: F.when((i < kept) | ((i == kept) & (d == 0)), d)
        .when(i == kept, (_draw(key, entity, attempt, i, 9) + 1).cast("int"))
        .otherwise(_draw(key, entity, attempt, i, 10).cast("int")),
    )
    return F.concat(new, _more(attempt, 4, lambda i: _draw(key, entity, attempt, i, 10).cast("int")))


def _card(key: str, entity: Column, attempt: Column) -> Column:
    def checked(new: Column) -> Column:
        body = F.slice(new, F.lit(1), F.size(new) - 1)
        rest = F.pmod(F.lit(10) - F.pmod(_luhn(F.concat(body, F.array(F.lit(0)))), F.lit(10)), F.lit(10))
        own = F.transform(F.split(F.regexp_replace(entity, "[^0-9]", ""), ""), lambda d: F.coalesce(d.cast("int"), F.lit(0)))
        right = F.pmod(_luhn(own), F.lit(10)) == 0
        return F.concat(body, F.array(F.when(right, rest).otherwise(F.pmod(rest + 1, F.lit(10)))))

    return F.array_join(let(_numbers(key, entity, attempt, F.lit(1)), checked), "")


def _email(key: str, entity: Column, attempt: Column) -> Column:
    local = F.regexp_extract(entity, "^([^@]*)@", 1)
    letters = F.lit("abcdefghijklmnopqrstuvwxyz")
    chars = F.transform(
        F.filter(F.split(local, ""), lambda c: c != ""),
        lambda c, i: F.when(c.rlike("[a-z]"), F.substring(letters, (_draw(key, entity, attempt, i, 26) + 1).cast("int"), F.lit(1)))
        .when(c.rlike("[0-9]"), _digit(_draw(key, entity, attempt, i, 10))).otherwise(c),
    )
    # After a few attempts a short local part grows, so that there is always a free one.
    more = F.when(attempt > 3, _digit(_draw(key, entity, attempt, 99, 1_000_000_000))).otherwise(F.lit(""))
    more = F.concat(more, F.array_join(_more(attempt, 4, lambda i: _digit(_draw(key, entity, attempt, i, 10))), ""))
    host = F.concat(F.lit("mail"), _digit(_draw(key, F.regexp_extract(entity, "@(.*)$", 1), F.lit(0), 98, 1000)), F.lit(".example.org"))
    return F.concat(F.array_join(chars, ""), more, F.lit("@"), host)


def _name(key: str, entity: Column, attempt: Column) -> Column:
    title = F.regexp_extract(entity, r"^([\p{L}]+)", 1)
    gender = F.when(title.isin(*MALE_TITLES), "m").otherwise("f")
    script = F.when(F.regexp_replace(entity, r"^[\p{L}]+ ", "").rlike(r"\p{IsCyrillic}"), "cyrillic").otherwise("latin")
    parts = F.size(F.split(entity, " ")) - 1
    pick = lambda names, i: F.element_at(F.array(*map(F.lit, names)), (_draw(key, entity, attempt, i, len(names)) + 1).cast("int"))

    def by_script(s: str) -> Column:
        given = F.when(gender == "m", pick(GIVEN["m", s], 1)).otherwise(pick(GIVEN["f", s], 1))
        # The family name is made of two list entries, and of one more with each attempt from the third on.
        family = F.concat(pick(FAMILY[s], 2), F.lower(pick(FAMILY[s], 3)), F.array_join(_more(attempt, 2, lambda i: F.lower(pick(FAMILY[s], i))), ""))
        return F.when(parts > 1, F.concat_ws(" ", given, family)).otherwise(family)

    return F.concat_ws(" ", title, F.when(script == "cyrillic", by_script("cyrillic")).otherwise(by_script("latin")))


def surrogate(key: str, kind: Column, entity: Column, attempt: Column) -> Column:
    octets = F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: _digit(_draw(key, entity, attempt, i, 254) + 1))
    groups = F.transform(F.sequence(F.lit(1), F.lit(6)), lambda i: F.lower(F.hex(_draw(key, entity, attempt, i, 1 << 16))))
    address = F.when(attempt > 4, F.concat(F.lit("2001:db8:"), F.array_join(groups, ":"))).otherwise(F.array_join(octets, "."))
    codes = F.when(entity.startswith("+"), F.length(F.regexp_extract(entity, r"^\+(1|7|2[07]|3[0-469]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})", 1))).otherwise(F.lit(0))
    phone = F.concat(F.when(entity.startswith("+"), "+").otherwise(""), F.array_join(_numbers(key, entity, attempt, codes), ""))
    return (
        F.when(kind == "email", _email(key, entity, attempt)).when(kind == "ip", address)
        .when(kind == "card", _card(key, entity, attempt)).when(kind == "name", _name(key, entity, attempt)).otherwise(phone)
    )


def assign(entities: DataFrame, key: str = KEY) -> DataFrame:
    """kind, entity, surrogate: distinct per kind and none an entity itself; entities are distinct rows."""
    done, todo, attempt = None, entities.select("kind", "entity"), 0
    while True:
        drawn = todo.withColumn("surrogate", surrogate(key, F.col("kind"), F.col("entity"), F.lit(attempt)))
        if done is not None:
            taken = done.select("kind", F.col("surrogate").alias("s"))
        else:
            taken = None
        own = entities.select("kind", F.col("entity").alias("s"))
        used = own if taken is None else own.union(taken)
        first = drawn.groupBy("kind", "surrogate").agg(F.min("entity").alias("entity"))
        good = first.join(used, (first["kind"] == used["kind"]) & (first["surrogate"] == used["s"]), "left_anti")
        part = cut(good.select("kind", "entity", "surrogate"))
        done = part if done is None else cut(done.unionByName(part))
        todo = cut(todo.join(part.select("kind", "entity"), ["kind", "entity"], "left_anti"))
        attempt += 1
        if todo.isEmpty():
            return done


def _like(m: Column, kind: Column, new: Column, entity: Column | None = None) -> Column:
    """The surrogate in the format of this mention: separators of numbers; title, parts and ending of names."""
    def spread(digits: Column) -> Column:
        marks = F.filter(F.split(m, ""), lambda c: c != "")
        return F.aggregate(
            marks,
            F.struct(F.lit(0).alias("i"), F.lit("").alias("t")),
            lambda a, c: F.when(c.rlike("[0-9]"), F.struct((a["i"] + 1).alias("i"), F.concat(a["t"], F.get(digits, a["i"])).alias("t")))
            .otherwise(F.struct(a["i"].alias("i"), F.concat(a["t"], c).alias("t"))),
            # A surrogate longer than the mention ends in its further digits.
            lambda a: F.concat(a["t"], F.array_join(F.slice(digits, a["i"] + 1, F.greatest(F.size(digits) - a["i"], F.lit(0))), "")),
        )

    digits = F.filter(F.split(new, ""), lambda c: c.rlike("^[0-9]$"))
    entity = m if entity is None else entity
    whole = F.regexp_replace(new, "^[^ ]+ ", "")
    part = (
        F.when(_bare(m) == _bare(entity), whole).when(entity.endswith(F.concat(F.lit(" "), _bare(m))), F.substring_index(new, " ", -1))
        .otherwise(F.substring_index(whole, " ", 1))
    )
    named = F.concat(F.regexp_extract(m, rf"^((?:{TITLES})\.? )?", 0), part, F.regexp_extract(m, "('s?)?$", 0))
    return F.when(kind.isin("card", "phone"), let(digits, spread)).when(kind == "name", named).otherwise(new)


def replace(docs: DataFrame, key: str = KEY) -> DataFrame:
    """doc_id, text (with surrogates), n_entities, and kinds (count by kind); one row per document row."""
    found = F.when(F.col("text").rlike(HINT), F.regexp_extract_all("text", F.col("pattern"), F.lit(0))).otherwise(
        F.array().cast("array<string>")
    )
    # Fixed per row, so that the mentions of a text's names are found behind, before and without their titles.
    none = F.array().cast("array<string>")
    names = F.coalesce(F.when(F.col("text").rlike(NAME), names_of(F.col("text"))), none)
    typed = F.transform(
        F.coalesce(found, F.array().cast("array<string>")),
        lambda m: let(kind_of(m), lambda k: F.struct(
            k.alias("kind"), F.when(k == "name", F.coalesce(same_name(m, F.col("names")), normal(m, k))).otherwise(normal(m, k)).alias("entity"), m.alias("m")
        )),
    )
    rows = docs.withColumn("names", names).withColumn("pattern", pattern_of(F.col("names"))).select("doc_id", text_key(F.col("text")).alias("tk"), typed.alias("found"))
    mentions = cut(
        rows.select("doc_id", "tk", F.posexplode_outer("found").alias("at", "e")).where(F.col("e").isNotNull())
        .select("doc_id", "tk", "at", "e.kind", "e.entity", "e.m").distinct()
    )
    named = assign(mentions.groupBy("kind", "entity").agg(F.count("*").alias("n")), key)
    new = (
        mentions.join(named, ["kind", "entity"])
        .groupBy("doc_id", "tk")
        .agg(
            F.sort_array(F.collect_list(F.struct("at", "kind", _like(F.col("m"), F.col("kind"), F.col("surrogate"), F.col("entity")).alias("s")))).alias("new")
        )
        .select(F.col("doc_id").alias("d"), F.col("tk").alias("t"), "new")
    )
    texts = docs.select("doc_id", "text", text_key(F.col("text")).alias("tk"))
    joined = texts.join(new, texts["doc_id"].eqNullSafe(F.col("d")) & (texts["tk"] == F.col("t")), "left")
    joined = joined.withColumn("pattern", F.when(F.col("new").isNotNull(), pattern_of(names)))
    between = F.split("text", F.col("pattern"), -1)
    text = let(between, lambda b: F.array_join(F.transform(b, lambda x, i: F.concat(x, F.coalesce(F.get("new", i)["s"], F.lit("")))), ""))
    count = lambda k: F.size(F.filter("new", lambda x: x["kind"] == k)).cast("long")
    some = F.col("new").isNotNull()
    return joined.select(
        "doc_id", F.when(some, text).otherwise(F.col("text")).alias("text"),
        F.coalesce(F.size("new"), F.lit(0)).cast("long").alias("n_entities"),
        *[F.when(some, count(k)).otherwise(F.lit(0)).cast("long").alias(f"n_{k}") for k in ("email", "phone", "ip", "card", "name")],
    )

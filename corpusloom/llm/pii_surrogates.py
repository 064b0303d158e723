"""Surrogates for personal data and secrets, in column expressions alone.

Detected entities are replaced by keyed surrogates of the same type and format. An entity's symbols (letters by
case, script and vowel or consonant; digits; hexadecimal digits; address octets) are permuted: a keyed
unbalanced Feistel network, a keyed shift of every symbol, and the network backwards. That is one-to-one on all
entities of a format and moves each of them, so equal entities stay equal and different ones different across the
whole corpus without a table. Names go word by word, so that a surname alone keeps the surrogate it has behind a
given name. Listed given names move inside their gender's and script's list, listed surnames inside their script's; for other names, and for
secrets of letters and digits, the permutation is walked on until its image is again no listed name, or again of
the secret's own kind, which keeps it one-to-one on those that are left. ``collisions`` checks all entities of a
table; ``replace`` runs it and takes another derived key where an entity would stand for itself.

Persons are found behind a title, or as a listed given name before a capitalised word, with up to two further words and the
initials and particles between; every name word found so counts again wherever else the same text has it, unless it is an
ordinary word (``ORDINARY``) or the text has it in small letters too. A name with neither title nor listed given name, or a
listed given name alone, is not found. Words of an address's local part move as names do, so a person and the address keep
agreeing; valid account numbers get valid check digits.
The key belongs to the caller: who has it can undo every surrogate.

Edge cases: a null text stays null and an empty one empty; texts without entities are returned unchanged; rows
are judged one by one, so null ids and repeated rows change nothing; an entity without any known letter or digit
stays as it is; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 4
#: Most steps of a walk; no format has as many listed names, and kinds of secrets come back far sooner.
WALK = 96

#: Given names by script and gender, and titles (fixed values).
GIVEN_NAMES = {
    "latin female": "Anna Maria Julia Laura Sarah Emma Claire Sophie Lucia Carmen Elena Ingrid Helga Heidi Monique Camille Isabel Teresa Alice Emily Jane Mary Linda Susan",
    "latin male": "John James Robert Michael David Thomas Peter Paul Hans Klaus Stefan Pierre Jacques Michel Carlos Miguel Pedro Juan Luis Jorge Henry George Frank Walter",
    "greek female": "Μαρία Ελένη Κατερίνα Σοφία Άννα Ιωάννα Βασιλική Γεωργία",
    "greek male": "Γιώργος Δημήτρης Νίκος Κώστας Γιάννης Παναγιώτης Χρήστος Βασίλης",
    "cyrillic female": "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана",
    "cyrillic male": "Иван Алексей Сергей Дмитрий Андрей Михаил Николай Павел",
}
#: Frequent surnames by script (fixed values).
SURNAMES = {
    "latin": "Smith Jones Taylor Williams Davies Evans Walker Roberts Robinson Wright Thompson Hughes Edwards Lewis Harris Clarke Jackson Turner Cooper Morris Müller Schmidt Schneider Fischer Weber Meyer Wagner Becker Schulz Hoffmann Koch Richter Martin Bernard Dubois Moreau Laurent Simon Lefebvre Leroy Garnier Fournier García Fernández González Rodríguez López Martínez Sánchez Pérez Gómez Ruiz Hernández Díaz Moreno Álvarez",
    "greek": "Παπαδόπουλος Παπαδοπούλου Γεωργίου Δημητρίου Νικολάου Ιωάννου Οικονόμου Αντωνίου Κωνσταντίνου Βασιλείου",
    "cyrillic": "Иванов Петров Сидоров Смирнов Кузнецов Попов Соколов Лебедев Новиков Морозов",
}
#: Words between the parts of a name, and ordinary words that are names too, which stand for a person only inside one (fixed values).
PARTICLES = "de la las los del di da do dos das du des der den van von vom zu zur af av bin ibn el al y e"
ORDINARY = "May Will Mark Bill Bob Rob Pat Sue Rose Grace Hope Faith Joy Art Rich Frank Grant Chase Chance Drew Dean Earl Duke King Queen Prince Bishop Pope Abbot Knight Page Price Rice Rush Stone Wood Woods Hill Hall House Church Street Park Lake Rivers Brook Field Fields Ford West North South Day Summer Winter Spring April June July August Monday Friday Sunday Brown Black White Green Gray Young Long Short Small Little Strong Sharp Wise Love Good Best Fair Case Cash Bell Book Smart The This That These Those And But For With From When Where What There Then They You Your She Her His Its Our Not Are Was Were Has Had Can Could Would Should Must Der Die Das Und Les Des Una Los Las"
TITLES = "Mrs Mr Ms Miss Dr Prof Herr Frau Madame Mme Monsieur Mlle Señora Señor Sra Sr Κύριος Κυρία Господин Госпожа"
ALPHABETS = (
    "0123456789",
    "aeiou", "bcdfghjklmnpqrstvwxyz", "AEIOU", "BCDFGHJKLMNPQRSTVWXYZ",
    "áàâäéèêëíîïóôöúûü", "ÁÀÂÄÉÈÊËÍÎÏÓÔÖÚÛÜ", "çñ", "ÇÑ",
    "αεηιουω", "βγδζθκλμνξπρστφχψ", "ΑΕΗΙΟΥΩ", "ΒΓΔΖΘΚΛΜΝΞΠΡΣΤΦΧΨ", "άέήίόύώ", "ΆΈΉΊΌΎΏ",
    "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "АЕИОУЫЭЮЯ", "БВГДЖЗЙКЛМНПРСТФХЦЧШЩ",
)
_HEX = "0123456789abcdef"

_NAME = r"\p{Lu}[\p{L}'-]+"
#: Up to two further parts of a name, each with initials or particles before it.
_FURTHER = rf"(?: (?:\p{{Lu}}\. |(?:{'|'.join(PARTICLES.split())}) ){{0,3}}{_NAME}){{0,2}}"
_DIGITS = r"(?=(?:[ .()/-]{0,2}[0-9]){7,15}(?![0-9]))"
_SECRET_HEAD = r"(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)[ \t]*[=:][ \t]*[\"']?"
#: Entity types in the order in which they are tried at a position.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}",
    "secret": rf"(?<![A-Za-z0-9]){_SECRET_HEAD}(?=[^\s\"',;]*[0-9])[^\s\"',;]{{6,}}",
    "access_key": r"(?<![A-Za-z0-9])AKIA[0-9A-Z]{16}(?![A-Za-z0-9])",
    "phone": rf"(?<![0-9A-Za-z+])\+{_DIGITS}[0-9]{{1,3}}(?:[ .-]?\([0-9]{{1,4}}\))?(?:[ ./-]?[0-9]{{1,12}}){{1,6}}(?![0-9])|" r"(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}[-. ][0-9]{4}(?![0-9])|(?<![0-9A-Za-z.-])[0-9]{3}[-. ][0-9]{3}[-. ][0-9]{4}(?![0-9.-]*[0-9])",
    "ip": r"(?<![0-9A-Za-z.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?![0-9A-Za-z]|\.[0-9])",
    "ip6": r"(?<![0-9A-Za-z:.])(?:(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}|(?=(?:[0-9a-f]{1,4}:|:){2,7}[0-9a-f:]*[0-9a-f])(?=[a-f:]*[0-9])(?:[0-9a-f]{1,4}(?::[0-9a-f]{1,4}){0,6})?::(?:[0-9a-f]{1,4}(?::[0-9a-f]{1,4}){0,6}))(?![0-9A-Za-z:]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
    "person": rf"(?<![\p{{L}}])(?=\p{{Lu}})(?:(?:{'|'.join(TITLES.split())})\.? {_NAME}{_FURTHER}|(?:{'|'.join(' '.join(GIVEN_NAMES.values()).split())})(?:-\p{{Lu}}\p{{L}}+)?(?: (?:\p{{Lu}}\. |(?:{'|'.join(PARTICLES.split())}) ){{0,3}}{_NAME}){{1,2}})",
}
ENTITY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text without any of these characters or names holds no entity.
GATE = rf"[0-9@]|::|{PATTERNS['person']}"
_TITLE = rf"^(?:{'|'.join(TITLES.split())})\.? "
_POOLS = {**GIVEN_NAMES, **{f"{k} surnames": v for k, v in SURNAMES.items()}}
_LISTED = [n.lower() for names in _POOLS.values() for n in names.split()]


def entity_type(entity: Column) -> Column:
    kind = F.lit("person")
    for name, pattern in reversed(list(PATTERNS.items())):
        if name != "person":
            kind = F.when(F.rlike(entity, F.lit(f"^(?:{pattern})$")), F.lit(name)).otherwise(kind)
    return kind


def _let(value: Column, body) -> Column:
    """body(value) with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _tables() -> tuple[str, Column, Column]:
    starts, sizes, at = [], [], 1
    for a in (*ALPHABETS, _HEX):
        starts += [at] * len(a)
        sizes += [len(a)] * len(a)
        at += len(a)
    return "".join((*ALPHABETS, _HEX)), F.array(*[F.lit(x) for x in starts]), F.array(*[F.lit(x) for x in sizes])


def _stream(digest: Column, place: Column) -> Column:
    return F.conv(F.substr(digest, F.pmod(place * 4, F.lit(124)).cast("int") + 1, F.lit(4)), 16, 10).cast("int")


def _round(state: Column, sizes: Column, key: Column, number: Column, sign: Column) -> Column:
    """Adds (sign 1) or takes away (-1) a keyed amount at every other symbol, derived from the symbols between."""
    half = F.pmod(number, F.lit(2))
    others = F.filter(state, lambda s, i: F.pmod(i, F.lit(2)) != half)
    digest = F.sha2(F.concat_ws("|", key, number.cast("string"), F.size(state).cast("string"), F.concat_ws(",", F.transform(others, lambda x: x.cast("string")))), 512)
    return _let(
        digest,
        lambda d: F.zip_with(
            F.transform(state, lambda s, i: F.struct(s.alias("s"), i.alias("i"))), sizes,
            lambda s, n: F.when(F.pmod(s["i"], F.lit(2)) == half, F.pmod(s["s"] + sign * _stream(d, s["i"]), n)).otherwise(s["s"]),
        ),
    )


def _permuted(state: Column, sizes: Column, key: Column) -> Column:
    """The keyed one-to-one image of whole numbers below their sizes; never the numbers themselves."""
    rounds = F.array(*[F.lit(i) for i in range(1, ROUNDS + 1)])
    forward = F.aggregate(rounds, state, lambda acc, r: _round(acc, sizes, key, r, F.lit(1)))
    shift = F.sha2(F.concat_ws("|", key, F.lit("shift"), F.size(state).cast("string")), 512)
    shifted = _let(
        shift,
        lambda d: F.zip_with(
            F.transform(forward, lambda s, i: F.struct(s.alias("s"), i.alias("i"))), sizes,
            lambda s, n: F.pmod(s["s"] + 1 + F.pmod(_stream(d, s["i"]), F.greatest(n - 1, F.lit(1))), n),
        ),
    )
    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS, 0, -1)]), shifted, lambda acc, r: _round(acc, sizes, key, r, F.lit(-1)))


def _symbols(body: Column, mode: Column) -> Column:
    """Array of (token, start, size, value) for the mode plain, hex or octet; size 0 for what is kept as it is."""
    plain = "".join(ALPHABETS)
    _, starts, sizes = _tables()
    tokens = F.regexp_extract_all(body, F.when(mode == "octet", F.lit("[0-9]+|[^0-9]")).otherwise(F.lit("(?s).")), 0)
    hexed = lambda t: F.when(F.instr(F.lit(_HEX), t) > 0, F.instr(F.lit(_HEX), t) + len(plain)).otherwise(F.lit(0))
    place = lambda t: F.when(mode == "octet", F.when(F.rlike(t, F.lit("^[0-9]+$")), F.lit(1)).otherwise(F.lit(0))).when(mode == "hex", hexed(t)).otherwise(F.instr(F.lit(plain), t))
    return F.transform(
        F.transform(tokens, lambda t: F.struct(t.alias("t"), place(t).alias("p"))),
        lambda x: F.when(x["p"] == 0, F.struct(x["t"].alias("token"), F.lit(0).alias("start"), F.lit(0).alias("size"), F.lit(0).alias("value")))
        .when(mode == "octet", F.struct(x["t"].alias("token"), F.lit(0).alias("start"), F.lit(256).alias("size"), x["t"].try_cast("int").alias("value")))
        .otherwise(F.struct(x["t"].alias("token"), F.element_at(starts, x["p"]).alias("start"), F.element_at(sizes, x["p"]).alias("size"), (x["p"] - F.element_at(starts, x["p"])).alias("value"))),
    )


def _class(kind: Column, body: Column) -> Column:
    """What a surrogate must share with the body: a secret's kind of symbols, and whether a name is listed."""
    symbols = F.when(F.rlike(body, F.lit("^[0-9]+$")), 0).when(F.rlike(body, F.lit("^[0-9a-f]+$")), 1).otherwise(2)
    return F.when(kind == "secret", symbols).when(kind == "person", F.lower(body).isin(_LISTED).cast("int")).otherwise(0)


def _spelled(body: Column, kind: Column, key: Column) -> Column:
    """The body with its symbols permuted inside their alphabets, walked on until it is of its own class again."""
    master = _tables()[0]
    mode = F.when(kind == "ip", "octet").when(((kind == "secret") & (_class(kind, body) == 1)) | (kind == "ip6"), "hex").otherwise("plain")
    rank = lambda symbols, i: F.size(F.filter(F.slice(symbols, F.lit(1), i + 1), lambda y: y["size"] > 0))
    written_as = lambda s, v: F.when(kind == "ip", v.cast("string")).otherwise(F.substr(F.lit(master), s["start"] + v, F.lit(1)))

    def woven(symbols: Column) -> Column:
        sizes = F.transform(F.filter(symbols, lambda s: s["size"] > 0), lambda s: s["size"])
        values = F.transform(F.filter(symbols, lambda s: s["size"] > 0), lambda s: s["value"])
        word = lambda out: F.array_join(F.transform(symbols, lambda s, i: F.when(s["size"] > 0, written_as(s, F.element_at(out, F.greatest(rank(symbols, i), F.lit(1))))).otherwise(s["token"])), "")

        def step(a: Column, _: Column) -> Column:
            moved = lambda v: F.struct(v.alias("values"), word(v).alias("word"))
            judged = lambda m: F.struct(m["values"].alias("values"), m["word"].alias("word"), (_class(kind, m["word"]) == _class(kind, body)).alias("done"))
            return F.when(a["done"], a).otherwise(_let(_let(_permuted(a["values"], sizes, key), moved), judged))

        start = F.struct(values.alias("values"), body.alias("word"), (F.size(values) == 0).alias("done"))
        return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), start, step)["word"]

    return _let(_symbols(body, mode), woven)


def _luhn(number: Column) -> Column:
    """The check sum of a digit string modulo 10; 0 for a valid card number."""
    digits = F.transform(F.regexp_extract_all(F.reverse(number), F.lit("[0-9]"), 0), lambda d: d.cast("int"))
    worth = F.transform(digits, lambda d, i: F.when(F.pmod(i, F.lit(2)) == 0, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0)))
    return F.pmod(F.aggregate(worth, F.lit(0), lambda a, x: a + x), F.lit(10))


def _mod97(account: Column) -> Column:
    """The remainder by 97 of an account number with its first four characters at the end and letters as 10 to 35."""
    turned = F.concat(F.substring(account, 5, 60), F.substring(account, 1, 4))
    digits = F.flatten(F.transform(F.regexp_extract_all(turned, F.lit("[0-9A-Z]"), 0), lambda c: F.when(c.between("0", "9"), F.array(c.try_cast("int"))).otherwise(F.array(F.floor((F.ascii(c) - 55) / 10).cast("int"), F.pmod(F.ascii(c) - 55, F.lit(10))))))
    return F.aggregate(digits, F.lit(0), lambda a, d: F.pmod(a * 10 + d, F.lit(97)))


def _successors(key: str) -> Column:
    """A map from each listed name, in small letters, to its successor by a keyed step among the names of its length in its
    list. The key is known before anything is planned, so this is one literal."""
    out = {}
    for pool, names in _POOLS.items():
        for group in _alike(names.split()):
            step = int(hashlib.sha256(f"{key}|person|{pool}".encode()).hexdigest()[:8], 16) % (len(group) - 1) + 1
            out |= {n.lower(): group[(i + step) % len(group)] for i, n in enumerate(group)}
    return F.from_json(F.lit(json.dumps(out)), "map<string,string>")


def _listed(name: Column, successors: Column) -> Column:
    """A listed name's successor, in capitals for capitals and small letters for small ones; null for other names."""
    return _let(successors[F.lower(name)], lambda n: F.when(name == F.upper(name), F.upper(n)).when(name == F.lower(name), F.lower(n)).otherwise(n))


def _alike(names: list[str]) -> list[list[str]]:
    """The names of a list by length, those of a length that no other has together."""
    by: dict[int, list[str]] = {}
    for n in names:
        by.setdefault(len(n), []).append(n)
    lone = [n for group in by.values() if len(group) == 1 for n in group]
    groups = [group for group in by.values() if len(group) > 1]
    if len(lone) == 1 and groups:
        groups[0] += lone
    return groups + ([lone] if len(lone) > 1 else [])


def surrogate(entity: Column, key: str) -> Column:
    """The surrogate of an entity found by ``entities``: what its type keeps in front and behind, the rest permuted.

    E-mail addresses keep their last label, secrets and access keys their heads, phone numbers the country, cards
    the first digit and their check sum, accounts the country, persons the title and so their gender.
    """

    def of(kind: Column) -> Column:
        head = (
            F.when(kind == "secret", F.regexp_extract(entity, f"^{_SECRET_HEAD}", 0)).when(kind == "access_key", F.lit("AKIA"))
            .when(kind == "phone", F.regexp_extract(entity, r"^(?:\+[0-9]{1,3})?", 0)).when(kind == "card", F.substring(entity, 1, 1))
            .when(kind == "iban", F.substring(entity, 1, 2)).when(kind == "person", F.regexp_extract(entity, _TITLE, 0)).otherwise(F.lit(""))
        )
        tail = F.when(kind == "email", F.regexp_extract(entity, r"\.[A-Za-z]+$", 0)).when(kind == "card", F.substring(entity, -1, 1)).otherwise(F.lit(""))
        return _let(F.struct(head.alias("head"), tail.alias("tail")), lambda p: assembled(kind, F.concat_ws("|", F.lit(key), kind), p))

    def assembled(kind: Column, k: Column, p: Column) -> Column:
        body = F.substr(entity, F.length(p["head"]) + 1, F.length(entity) - F.length(p["head"]) - F.length(p["tail"]))
        parts = F.when(kind == "person", F.regexp_extract_all(body, F.lit("[^ -]+|[ -]"), 0)).when(kind == "email", F.regexp_extract_all(body, F.lit(r"\p{L}+(?=[^@]*@)|\p{L}*[^\p{L}@]+(?=[^@]*@)|@.*"), 0)).otherwise(F.array(body))
        # Words of an address's local part move as names do, so that a person and the address keep agreeing.
        named = lambda b: (kind == "person") | ((kind == "email") & F.rlike(b, F.lit(r"^\p{L}+$")))
        name_key = F.concat_ws("|", F.lit(key), F.lit("person"))
        listed = lambda b: F.when(named(b), _listed(b, _successors(key)))
        as_kind, with_key = (lambda b: F.when(named(b), F.lit("person")).otherwise(kind)), (lambda b: F.when(named(b), name_key).otherwise(k))
        moved = F.transform(parts, lambda b: F.when(b.isin(" ", "-", *PARTICLES.split()) & (kind == "person"), b).otherwise(F.coalesce(listed(b), _spelled(b, as_kind(b), with_key(b)))))
        check = lambda w: F.pmod(_luhn(entity) - _luhn(F.concat(w, F.lit("0"))), F.lit(10)).cast("string")
        account = lambda w: F.concat(F.substring(w, 1, 2), F.lpad((98 - _mod97(F.concat(F.substring(w, 1, 2), F.lit("00"), F.substring(w, 5, 60)))).cast("string"), 2, "0"), F.substring(w, 5, 60))
        valid = (kind == "iban") & (_mod97(entity) == 1)
        return _let(F.concat(p["head"], F.array_join(moved, "")), lambda w: F.when(valid, account(w)).otherwise(F.concat(w, F.when(kind == "card", check(w)).otherwise(p["tail"]))))

    return _let(entity_type(entity), of)


def _pattern(text: Column) -> Column:
    """``ENTITY`` and every name word of the text's persons; null where there is none."""
    persons = F.when(F.rlike(text, F.lit(PATTERNS["person"])), F.regexp_extract_all(text, F.lit(PATTERNS["person"]), 0))
    words = F.array_distinct(F.flatten(F.transform(persons, lambda p: F.split(F.regexp_replace(p, _TITLE, ""), "[ -]"))))
    plain = lambda n: F.rlike(text, F.concat(F.lit(r"(?<!\p{L})"), F.lower(n), F.lit(r"(?!\p{L})")))  # noqa: E731  the text has it as an ordinary word too
    names = F.filter(words, lambda n: F.rlike(n, F.lit(r"^\p{Lu}[\p{L}']+$")) & (F.length(n) > 2) & ~n.isin(*ORDINARY.split()) & ~plain(n))
    return _let(names, lambda n: F.when(F.size(n) > 0, F.concat(F.lit(rf"{ENTITY}|(?<![\p{{L}}])(?:"), F.array_join(n, "|"), F.lit(r")(?![\p{L}])"))))


def entities(text: Column) -> Column:
    """The entities of a text in order; null for a null text."""
    found = _let(_pattern(text), lambda p: F.when(p.isNotNull(), F.regexp_extract_all(text, p, 0)).otherwise(F.regexp_extract_all(text, F.lit(ENTITY), 0)))
    return F.when(F.rlike(text, F.lit(GATE)), found).when(text.isNotNull(), F.array().cast("array<string>"))


def replaced(text: Column, found: Column, key: str) -> Column:
    """The text with its entities (as ``entities`` found them) replaced."""

    def woven(pattern: Column) -> Column:
        between = F.when(pattern.isNotNull(), F.split(text, pattern, -1)).otherwise(F.split(text, ENTITY, -1))
        return F.array_join(F.zip_with(between, found, lambda b, e: F.concat(b, F.coalesce(surrogate(e, key), F.lit("")))), "")

    return F.when(F.size(found) > 0, _let(_pattern(text), woven)).otherwise(text)


def pairs(docs: DataFrame, key: str) -> DataFrame:
    """Every distinct entity of a table: kind, entity, surrogate, rows."""
    each = docs.select(F.explode(entities(F.col("text"))).alias("entity")).groupBy("entity").agg(F.count("*").alias("rows"))
    return each.select(entity_type(F.col("entity")).alias("kind"), "entity", surrogate(F.col("entity"), key).alias("surrogate"), "rows")


def collisions(docs: DataFrame, key: str) -> DataFrame:
    """Surrogates that stand for several entities (but for case), or for themselves."""
    same = F.lower("entity")
    by = pairs(docs, key).groupBy("kind", F.lower("surrogate").alias("surrogate")).agg(F.min(same).alias("a"), F.max(same).alias("b"))
    movable = F.rlike(F.col("a"), F.lit(f"[{''.join(ALPHABETS)}]"))
    return by.where((F.col("a") != F.col("b")) | ((F.col("a") == F.col("surrogate")) & movable))


def replace(docs: DataFrame, key: str, attempts: int = 4) -> DataFrame:
    """docs with text replaced and a column __pii_found of entities; all other columns unchanged."""
    for attempt in range(attempts):
        used = key if attempt == 0 else f"{key}#{attempt}"
        if collisions(docs, used).isEmpty():
            break
    else:
        raise ValueError(f"surrogates collide under {attempts} keys derived from the given one")
    found = docs.withColumn("__pii_found", entities(F.col("text")))
    return found.withColumn("text", replaced(F.col("text"), F.col("__pii_found"), used))

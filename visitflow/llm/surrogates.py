"""Operator 5: surrogates for personal data, with DataFrame functions only.

Emails, phone, card, account, social-security and IP numbers and names behind a title are found by
one regular expression.  Each distinct entity (in canonical form: lower case, digits alone) gets a
surrogate from a keyed hash: letters for letters, digits for digits, the same e-mail domain for the
same domain, valid check digits for valid ones, made-up names of the same script and gender.  A
surrogate that two entities share, or that is itself an entity of the corpus, is drawn anew, so
distinct entities stay distinct; equal entities get equal surrogates in every document.  Each
occurrence then takes the surrogate in its own format.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

_EMAIL = r"(?<![A-Za-z0-9._%+-])(?=[._%+-]*+[A-Za-z0-9])[A-Za-z0-9._%+-]++@(?=[.-]*+[A-Za-z0-9])[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*+"
_IP = r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"
_PHONE = r"\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_CARD = r"(?<!\d)(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}|\d{13,19})(?!\d)"
_IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
_MALE = r"Mr\.?|Herr|Monsieur|Señor|Sr\.|Господин|Κύριος"
_FEMALE = r"Mrs\.?|Ms\.?|Miss|Frau|Madame|Mme|Señora|Sra\.|Госпожа|Κυρία"
_EITHER = r"Dr\.?|Prof\.?"
_WORD = r"\p{Lu}[\p{L}'’-]+"
_NAME = rf"(?<!\p{{L}})(?:{_MALE}|{_FEMALE}|{_EITHER}) {_WORD}(?: {_WORD}){{0,2}}"
#: Tried in this order where a match fits several.
KINDS = {"email": _EMAIL, "ip": _IP, "phone": _PHONE, "ssn": _SSN, "card": _CARD, "iban": _IBAN}
#: One pattern for all; a look at the next character spares the others at most places.
PATTERN = (rf"{_EMAIL}|(?=[A-Z]){_IBAN}|(?=[MHSDPFГΚ]){_NAME}"
           rf"|(?=[+(0-9])(?:{_IP}|{_PHONE}|{_SSN}|{_CARD})")
#: Draws of one e-mail domain, and the draw from which surrogates get longer by one place a draw.
SAME_DOMAIN, LONGER = 4, 8

#: Syllables of made-up names: consonants and vowels by script, endings by gender.
_SYLLABLES = {
    "latin": ("bdfghjklmnprstvz", "aeiou", {"male": ["o", "us", "en"], "female": ["a", "ia", "ine"], "": ["er", "ok", "ell"]}),
    "cyrillic": ("бвгджзклмнпрст", "аеиоу", {"male": ["ов", "ин", "ей"], "female": ["ова", "ина", "ея"], "": ["ко", "ук", "их"]}),
    "greek": ("βγδζθκλμνπρστφ", "αεηιο", {"male": ["ος", "ης", "ας"], "female": ["α", "η", "ου"], "": ["ιδι", "ακι", "ελι"]}),
}


def _bytes(key: str, draw: int, *parts) -> Column:
    """1024 hash bits as hex digits."""
    return F.concat(*(F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(f"{draw}.{k}"), *parts), 256) for k in range(4)))


def _number(hexed: Column, at) -> Column:
    """The hash byte pair at a place, from 0 to 65535."""
    return F.conv(F.substr(hexed, (at % 64) * 4 + F.lit(1), F.lit(4)), 16, 10).cast("int")


def _scrambled(text: Column, hexed: Column, keep: int | Column = 0) -> Column:
    """Letters for letters, digits for digits, all else kept, as are the first ``keep`` places."""
    def one(c, i):
        n = _number(hexed, i)
        return (F.when(i < keep, c).when(c.rlike("^[0-9]$"), (n % 10).cast("string")).when(c.rlike("^[a-z]$"), F.char(97 + n % 26))
                .when(c.rlike("^[A-Z]$"), F.char(65 + n % 26)).otherwise(c))
    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a string of digits, from the right."""
    doubled = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + x)


def _name(canon: Column, gender: Column, hexed: Column, syllables: int) -> Column:
    out = F.lit(None).cast("string")
    for script, test in (("cyrillic", r"\p{IsCyrillic}"), ("greek", r"\p{IsGreek}"), ("latin", ".")):
        consonants, vowels, endings = _SYLLABLES[script]
        pick = lambda letters, k: F.substr(F.lit(letters), _number(hexed, F.lit(k)) % len(letters) + 1, F.lit(1))
        body = F.concat(*(pick(x, 2 * k + j) for k in range(syllables) for j, x in enumerate((consonants, vowels))), pick(consonants, 2 * syllables))
        end = F.lit("")
        for g, chosen in endings.items():
            end = F.when(gender == g, F.element_at(F.array(*map(F.lit, chosen)), _number(hexed, F.lit(63)) % len(chosen) + 1)).otherwise(end)
        out = F.coalesce(out, F.when(canon.rlike(test), F.concat(body, end)))
    return out


def surrogate(kind: Column, canon: Column, key: str, draw: int) -> Column:
    """The ``draw``-th surrogate of an entity, in canonical form; from draw LONGER on longer than the entity."""
    hexed = _bytes(key, draw, kind, canon)
    extra = range(max(0, draw - LONGER + 1))
    digits = F.concat(F.lit(""), *((_number(hexed, F.lit(63 - k)) % 10).cast("string") for k in extra))
    letters = F.concat(F.lit(""), *(F.char(97 + _number(hexed, F.lit(63 - k)) % 26) for k in extra))
    scrambled = F.concat(_scrambled(canon, hexed, F.when(kind == "iban", 2).when((kind == "phone") & canon.startswith("+"), 2).otherwise(0)), digits)
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    names = F.regexp_extract(domain, r"^(.*)(\.[^.]*)$", 1)
    by_domain = _bytes(key, draw // SAME_DOMAIN, F.lit("domain"), domain)
    site = F.concat(_scrambled(names, by_domain), F.regexp_extract(domain, r"^(.*)(\.[^.]*)$", 2))
    email = F.concat(_scrambled(local, hexed), letters, F.lit("@"), F.when(F.instr(domain, ".") > 0, site).otherwise(_scrambled(domain, by_domain)))
    ip = F.concat_ws(".", *((_number(hexed, F.lit(k)) % 254 + 1).cast("string") for k in range(4 + len(extra))))
    card = scrambled
    fixed = F.concat(F.substr(card, F.lit(1), F.length(card) - 1), ((10 - _luhn(F.concat(F.substr(card, F.lit(1), F.length(card) - 1), F.lit("0"))) % 10) % 10).cast("string"))
    return (
        F.when(kind == "email", email).when(kind == "ip", ip)
        .when(kind == "card", F.when(_luhn(canon) % 10 == 0, fixed).otherwise(card))
        .when(kind.isin("phone", "iban", "ssn"), scrambled)
        .otherwise(_name(canon, F.regexp_extract(kind, "^name:?(.*)$", 1), hexed, 2 + draw // 4)))


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, h (hash of the text), place (number of the match), part (of a match), kind, canon, found:
    one row for each entity found; a name has one row for its title and each of its words."""
    found = docs.where(F.col("text").rlike(PATTERN)).select("doc_id", F.xxhash64("text").alias("h"), "text").distinct().select(
        "doc_id", "h", F.posexplode(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).alias("place", "match"))
    kind = F.lit("name")
    for name, pattern in reversed(KINDS.items()):
        kind = F.when(F.col("match").rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)
    found = found.withColumn("kind", kind)
    words = F.when(F.col("kind") == "name", F.split("match", " ")).otherwise(F.array("match"))
    gender = F.when(F.col("match").rlike(rf"^(?:{_FEMALE}) "), "female").when(F.col("match").rlike(rf"^(?:{_MALE}) "), "male").otherwise("")
    found = found.withColumn("gender", gender).withColumn("n", F.size(words)).select(
        "doc_id", "h", "place", "kind", "gender", "n", F.posexplode(words).alias("part", "found"))
    is_name = F.col("kind") == "name"
    given = is_name & (F.col("part") < F.col("n") - 1)  # the last word is the family name and has no gender
    kind = F.when(is_name & (F.col("part") == 0), "title").when(given, F.concat(F.lit("name:"), F.col("gender"))).when(is_name, "name:").otherwise(F.col("kind"))
    digits = F.regexp_replace("found", "[^0-9]", "")
    canon = (
        F.when(F.col("kind") == "phone", F.concat(F.when(F.col("found").startswith("+"), "+").otherwise(""), digits))
        .when(F.col("kind").isin("card", "ssn"), digits).when(F.col("kind") == "iban", F.regexp_replace("found", " ", ""))
        .when(F.col("kind") == "ip", F.col("found")).otherwise(F.lower("found")))
    return found.withColumn("kind", kind).withColumn("canon", canon).select("doc_id", "h", "place", "part", "kind", "canon", "found")


def mapping(entities: DataFrame, key: str) -> DataFrame:
    """kind, canon, surrogate for distinct entities (kind, canon): no surrogate twice within a kind,
    none that is itself an entity of that kind.  Where a format has too few values, surrogates get
    longer with each draw (see surrogate()), so every entity gets one."""
    entities = cut(entities)
    pending, assigned = entities, None
    for draw in count():
        drawn = cut(pending.withColumn("surrogate", surrogate(F.col("kind"), F.col("canon"), key, draw)))
        taken = entities.select("kind", F.col("canon").alias("surrogate"))
        if assigned is not None:
            taken = taken.union(assigned.select("kind", "surrogate"))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("canon").alias("canon")).join(taken, ["kind", "surrogate"], "left_anti")
        first = first.select("kind", "canon", "surrogate")
        assigned = cut(first if assigned is None else assigned.union(first))
        pending = cut(pending.join(assigned, ["kind", "canon"], "left_anti"))
        if pending.isEmpty():
            return assigned


def _in_format(found: Column, kind: Column, made: Column) -> Column:
    """The canonical surrogate with the separators and capitals of the occurrence."""
    chars = F.split(found, "")
    spaced = F.aggregate(  # fill the places of letters and digits, keep the rest; what a longer surrogate has left comes last
        chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")),
        lambda s, c: F.when(c.rlike("^[A-Za-z0-9+]$"), F.struct(F.concat(s["out"], F.substr(made, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at")))
        .otherwise(F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))),
        lambda s: F.concat(s["out"], F.substr(made, s["at"], F.length(made))))
    cased = F.array_join(F.transform(F.split(made, ""), lambda c, i: F.when(F.substr(found, i + 1, F.lit(1)).rlike(r"^\p{Lu}$"), F.upper(c)).otherwise(c)), "")
    shouted = (F.length(found) > 1) & (found == F.upper(found))
    named = F.when(shouted, F.upper(made)).otherwise(F.concat(F.upper(F.substr(made, F.lit(1), F.lit(1))), F.substr(made, F.lit(2), F.length(made))))
    return F.when(kind == "title", found).when(kind.startswith("name"), named).when(kind == "email", cased).when(kind == "ip", made).otherwise(spaced)


def replace_private(docs: DataFrame, key: str = "surrogate key") -> DataFrame:
    """Every column of ``docs`` with the entities in text replaced, and n_entities (matches replaced).

    Null and empty texts are unchanged with 0 entities; repeated rows are replaced alike; a null
    doc_id is a doc_id like others; an empty table gives no row; a column named n_entities is
    replaced.  ``key`` decides all surrogates: keep it secret."""
    docs = docs.drop("n_entities")
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = cut(occurrences(plain))
    made = mapping(found.where("kind <> 'title'").select("kind", "canon").distinct(), key)
    parts = found.join(made, ["kind", "canon"], "left").select("doc_id", "h", F.struct("place", "part", _in_format(F.col("found"), F.col("kind"), F.col("surrogate")).alias("new")).alias("new"))
    by_doc = cut(
        parts.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list("new")).alias("new"))  # the matches of one document
        .select(F.col("doc_id").alias("__doc_id"), F.col("h").alias("__h"), "new"))
    hit = F.coalesce(F.col("text").rlike(PATTERN), F.lit(False))
    gaps = F.split("text", PATTERN, -1)
    words = lambda i: F.array_join(F.transform(F.filter("__new", lambda n: n["place"] == i - 1), lambda n: n["new"]), " ")
    text = F.array_join(F.transform("__gaps", lambda gap, i: F.when(i == 0, gap).otherwise(F.concat(words(i), gap))), "")
    columns = docs.columns
    changed = (
        docs.where(hit).withColumn("__k", F.xxhash64("text"))
        .join(by_doc.withColumnRenamed("new", "__new"), F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.col("__k") == F.col("__h")))
        .withColumn("__gaps", gaps).withColumn("text", text)
        .select(*columns, (F.size("__gaps") - 1).alias("n_entities")))
    return changed.unionByName(docs.where(~hit).select(*columns, F.lit(0).alias("n_entities")))

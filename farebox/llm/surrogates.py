"""Personal data replaced by keyed surrogates of the same type and form, in SQL functions only.

Found are mail and IP addresses, phone, card, account and social security numbers, keys and hashes,
and names behind a form of address, whole: with inner capitals, apostrophes, hyphens, initials and the
small words between. A run of digits is a card number if its last digit is the check digit. An entity's canonical form (digits of a number, lower case of
an address) and a secret key determine its surrogate, so mentions of one entity get one surrogate
wherever and however they are written: digits are put back into the mention's own punctuation,
letters into its case. Letters become letters of the same script, digits digits; a form of address
keeps its gender, a card its first digit, an address its top-level domain.

Distinctness is checked over the whole corpus: a surrogate that another entity also got, or that is
itself an entity of the corpus, is drawn again for all but one of them, until none is left. An entity
that finds none of its own length takes a longer one, so that small forms do not run out. The check
works on distinct entities only; texts move only if they hold some, and each text of a group of equal
ones is read once for it.

Null texts stay null, empty ones empty. Rows that repeat get the same result.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import staged

# Forms of address by gender (x: either), words that join names, beginnings of keys.
TITLES = {
    "m": "Mr|Herr|Hr|Monsieur|Señor|Sr|Господин", "f": "Mrs|Ms|Miss|Frau|Mme|Madame|Mlle|Señora|Sra|Госпожа",
    "x": "Dr|Prof|Professor",
}
PARTICLES = "van|von|der|den|de|del|della|di|da|du|la|le|zu"
KEYS = r"AKIA|ASIA|(?:sk|pk|ghp|xox[bp])[-_]"

# A word of a name: an initial, or letters with capitals, apostrophes and hyphens inside.
_WORD = r"(?:\p{Lu}\.|\p{Lu}[\p{L}\p{M}]*+(?:['’-]\p{L}[\p{L}\p{M}]*+)*+)"
_SMALL = rf"(?:(?:{PARTICLES}) ){{0,2}}"
_NAME = rf"{_SMALL}{_WORD}(?: {_SMALL}{_WORD}){{0,3}}"
_HEX = "[0-9A-Fa-f]{1,4}"


def _named(gender: str) -> str:
    more = r"(?:(?:Dr|Prof)\.? ){0,2}"
    begins = "".join(sorted({t[0] for t in TITLES[gender].split("|")}))
    return rf"(?=[{begins}])(?<!\w)(?:{TITLES[gender]})\.? {more}{_NAME}"


# Forms of what is looked for, in the order of preference, and what each of them must contain.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24}",
    "ip": r"(?<![\w.])(?:\d{1,3}\.){3}\d{1,3}(?![\w]|\.\d)",
    "ip6": rf"(?<![\w:.])(?=[A-Fa-f:]*\d)(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![\w:])",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "phone": r"(?=[+(\d])(?<![\w+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}"
             r"|\(\d{3}\) ?\d{3}[ .-]\d{4}|\d{3}[ .-]\d{3}[ .-]\d{4}|0\d{2,4}[ /-]\d{6,8})(?!\w)",
    "account": r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",
    "card": r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])",
    "secret": r"(?<!\w)(?:[0-9a-f]{32,128}|[0-9A-F]{32,128}|(?:AKIA|ASIA)[0-9A-Z]{16}"
              r"|(?:sk|pk|ghp|xox[bp])[-_][A-Za-z0-9_-]{16,128})(?!\w)",
    "name_m": _named("m"),
    "name_f": _named("f"),
    "name_x": _named("x"),
}
HINTS = {
    "email": "@", "secret": rf"[0-9a-f]{{32}}|[0-9A-F]{{32}}|{KEYS}",
    **{f"name_{g}": rf"(?:{t})\.? " for g, t in TITLES.items()},
    **{k: r"\d" for k in ("ip", "ip6", "ssn", "phone", "account", "card")},
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
# A text without it has no entity and is not searched.
HINT = "|".join(dict.fromkeys(HINTS.values()))
_ADDRESS = "^(?:(?:" + "|".join(TITLES.values()) + r")\.? )+"

# Given names by gender and script (fixed lists, kept short).
GIVEN = {
    ("m", "latin"): "Adam Bruno Carl David Emil Felix Hugo Ivan Jonas Leon Marco Nils Oscar Paul Simon Victor",
    ("f", "latin"): "Alma Beth Clara Diana Elena Flora Greta Helen Irene Julia Laura Maria Nora Olga Paula Sara",
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Семён Юрий",
    ("f", "cyrillic"): "Алла Вера Галина Дарья Елена Жанна Зоя Ирина Клара Лариса Мария Нина Ольга Полина Софья Юлия",
}
for _script in ("latin", "cyrillic"):
    GIVEN["x", _script] = f"{GIVEN['m', _script]} {GIVEN['f', _script]}"
ALPHABETS = {
    "[0-9]": "0123456789", r"[a-z]|\p{IsLatin}": "abcdefghijklmnopqrstuvwxyz",
    r"\p{IsCyrillic}": "абвгдежзийклмнопрстуфхцчшщыэюя", r"\p{IsGreek}": "αβγδεζηθικλμνξοπρστυφχψω",
}
DIGITS = ("ssn", "phone", "card")
# Draws of a surrogate as long as the entity; each draw after these is one character longer.
ATTEMPTS = 50


def _other_alphabets() -> list[str]:
    """Letters of the other scripts that have case, one string for each script and form.

    Capitals without a small letter are letters of their own. Forms of few letters are one alphabet.
    """
    forms = defaultdict(str)
    for code in range(0xAA, 0x20000):
        c = chr(code)
        if unicodedata.category(c) not in ("Ll", "Lu") or c.lower() != c:
            continue
        name = unicodedata.name(c)
        if not re.match("(LATIN|FULLWIDTH LATIN|CYRILLIC|GREEK) ", name):
            forms[re.match(r"(.*LIGATURE|.*?\b(?:SMALL|CAPITAL)\b|\S+)", name)[1]] += c
    return [f for f in forms.values() if len(f) >= 10] + ["".join(f for f in forms.values() if len(f) < 10)]


OTHERS = _other_alphabets()


def _let(value: Column, use) -> Column:
    return F.element_at(F.transform(F.array(value), use), 1)


def found(text: Column) -> Column:
    """All mentions in a text, in order."""
    return F.when(F.coalesce(text.rlike(HINT), F.lit(False)), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
                  ).otherwise(F.array().cast("array<string>"))


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """The card checksum of digits from the right, where those at even or odd places count twice."""
    def weighed(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == doubled, d * 2 - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(
        F.transform(F.regexp_extract_all(F.reverse(digits), F.lit(r"\d"), F.lit(0)), weighed),
        F.lit(0), lambda total, d: total + d)


def _with_luhn(digits: Column) -> Column:
    """Digits whose last one is made the check digit of the others."""
    front = F.substring(digits, F.lit(1), F.length(digits) - 1)
    return F.concat(front, ((10 - _luhn_sum(front, 0) % 10) % 10).cast("string"))


def _with_account_check(account: Column) -> Column:
    """An account number with the check digits of its country and the rest."""
    country, rest = F.substring(account, 1, 2), F.substring(account, F.lit(5), F.length(account))
    place = lambda c: F.instr(F.lit("0123456789abcdefghijklmnopqrstuvwxyz"), c) - 1
    left = F.aggregate(
        F.transform(F.regexp_extract_all(F.lower(F.concat(rest, country, F.lit("00"))), F.lit("[0-9a-z]"), F.lit(0)), place),
        F.lit(0), lambda total, d: (total * F.when(d > 9, 100).otherwise(10) + d) % 97)
    return F.concat(country, F.lpad((98 - left).cast("string"), 2, "0"), rest)


def kind_of(mention: Column) -> Column:
    """What a mention is; null for a run of digits without a card's check digit."""
    which = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        is_kind = mention.rlike(f"^(?:{pattern})$")
        if kind == "card":
            which = F.when(is_kind, F.when(_luhn_sum(mention, 1) % 10 == 0, kind)).otherwise(which)
        else:
            which = F.when(is_kind, kind).otherwise(which)
    return which


def canonical(kind: Column, mention: Column) -> Column:
    return (F.when(kind.isin(*DIGITS), F.regexp_replace(mention, r"\D", ""))
            .when(kind == "account", F.replace(mention, F.lit(" "), F.lit("")))
            .when(kind.startswith("name"), F.lower(F.regexp_replace(mention, _ADDRESS, "")))
            .otherwise(F.lower(mention)))


def _number(stream: Column, at: Column) -> Column:
    """The byte of a hash at a place from 0 on."""
    return F.conv(F.substring(stream, at * 2 + 1, F.lit(2)), 16, 10).cast("int")


def _disguised(text: Column, seed: Column) -> Column:
    """Each letter or digit replaced by one of its kind, drawn from hashes of ``seed``."""
    stream = F.concat(*[F.sha2(F.concat(seed, F.lit(f"/{k}")), 512) for k in range(5)])

    def swap(stream: Column) -> Column:
        def other(c: Column, i: Column) -> Column:
            holding = F.filter(F.split(F.lit(" ".join(OTHERS)), " "), lambda letters: F.instr(letters, F.lower(c)) > 0)
            return F.coalesce(_let(F.get(holding, F.lit(0)), lambda letters: F.substring(
                letters, _number(stream, i) % F.length(letters) + 1, F.lit(1))), c)

        def one(c: Column, i: Column) -> Column:
            out = F.when(c.rlike(r"[\p{Ll}\p{Lu}]"), other(c, i)).otherwise(c)
            for pattern, letters in reversed(ALPHABETS.items()):
                drawn = F.substring(F.lit(letters), _number(stream, i) % len(letters) + 1, F.lit(1))
                out = F.when(F.lower(c).rlike(pattern), F.when(
                    (c != F.lower(c)), F.upper(drawn)).otherwise(drawn)).otherwise(out)
            return out
        return F.array_join(F.transform(F.split(text, ""), one), "")

    return _let(stream, swap)


def _pick(words: str, number: Column) -> Column:
    names = words.lower().split()
    return F.element_at(F.array(*map(F.lit, names)), number % len(names) + 1)


def surrogate(kind: Column, plain: Column, attempt: Column, key: str) -> Column:
    """The canonical form of the surrogate for a canonical form.

    After ``ATTEMPTS`` draws it is longer than that, by one character more with each draw.
    """
    more = F.greatest(attempt - (ATTEMPTS - 1), F.lit(0)).cast("int")
    seed = F.concat_ws("/", F.lit(key), kind, plain, attempt.cast("string"))
    # A card keeps its first digit, a full phone number that of its country.
    keeps = (kind == "card") | ((kind == "phone") & (F.length(plain) > 10))
    zeros, letters = F.repeat(F.lit("0"), more), F.repeat(F.lit("a"), more)
    after = lambda n: F.substring(plain, F.lit(n), F.length(plain))
    digits = F.when(keeps, F.concat(F.substring(plain, 1, 1), _disguised(F.concat(after(2), zeros), seed))
                    ).otherwise(_disguised(F.concat(plain, zeros), seed))
    digits = F.when(kind == "card", _with_luhn(digits)).otherwise(digits)
    octets = F.concat(F.array_join(F.transform(
        F.sequence(F.lit(0), F.lit(3)), lambda i: (_number(F.sha2(seed, 256), i) % 254 + 1).cast("string")), "."),
        _disguised(zeros, seed))
    at, dot = F.instr(plain, "@"), F.length(F.substring_index(plain, ".", -1)) + 1
    domain = F.substring(plain, at + 1, F.length(plain) - at - dot)
    mail = F.concat(
        _disguised(F.concat(F.substring_index(plain, "@", 1), letters), seed), F.lit("@"),
        # One domain has one surrogate, whatever the mailbox.
        _disguised(domain, F.concat_ws("/", F.lit(key), F.lit("domain"), domain)),
        F.lit("."), F.substring_index(plain, ".", -1))
    # A hash stays hexadecimal.
    hexes = F.substring(F.concat(F.sha2(seed, 512), F.sha2(F.concat(seed, F.lit("+")), 512)), F.lit(1), F.length(plain) + more)
    begin = F.regexp_extract(plain, f"^(?:{KEYS.lower()})", 0)
    hex_pool = F.concat(F.sha2(seed, 512), F.sha2(F.concat(seed, F.lit("-")), 512))
    ip6 = F.array_join(F.transform(F.split(F.concat(plain, F.repeat(F.lit(":0"), more)), ""), lambda c, i: F.when(
        c.rlike("[0-9a-f]"), F.substring(hex_pool, i + 1, F.lit(1))).otherwise(c)), "")
    word_seed = lambda word: F.sha2(F.concat_ws("/", F.lit(key), kind, word, attempt.cast("string")), 256)

    def given(word: Column) -> Column:
        number = _number(word_seed(word), F.lit(0))
        script = F.when(word.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))
        out = F.lit(None).cast("string")
        for (gender, letters), names in GIVEN.items():
            out = F.when((F.right(kind, F.lit(1)) == gender) & (script == letters), _pick(names, number)).otherwise(out)
        return F.when(word.rlike(r"[\p{IsLatin}\p{IsCyrillic}]"), out).otherwise(_disguised(word, word_seed(word)))

    words = F.split(plain, " ")
    # The last word always changes: it may be spelt like a particle.
    name = F.array_join(F.transform(words, lambda w, i: F.when(
        (i < F.size(words) - 1) & w.rlike(f"^(?:{PARTICLES})$"), w).when(
        (i < F.size(words) - 1) & ~w.endswith("."), given(w)).otherwise(
            # The last letter once more, so that the script stays.
            _disguised(F.concat(w, F.repeat(F.regexp_extract(w, r"(\p{L})\P{L}*$", 1), more)), word_seed(w)))), " ")
    return (F.when(kind.isin(*DIGITS), digits).when(kind == "ip", octets).when(kind == "ip6", ip6)
            .when(kind == "email", mail)
            .when(kind.startswith("name"), name)
            .when((kind == "secret") & plain.rlike("^[0-9a-f]+$"), hexes)
            .when(kind == "account", _with_account_check(
                F.concat(F.substring(plain, 1, 2), _disguised(F.concat(after(3), zeros), seed))))
            # A key keeps the beginning that tells what it is for.
            .when(kind == "secret", F.concat(begin, _disguised(
                F.concat(F.substring(plain, F.length(begin) + 1, F.length(plain)), letters), seed)))
            .otherwise(_disguised(F.concat(plain, letters), seed)))


def rendered(kind: Column, mention: Column, plain: Column) -> Column:
    """A surrogate's canonical form, written the way the mention was."""
    def fill(pattern: str) -> Column:
        """Characters of ``plain`` in the places of the mention that match the pattern, then the rest."""
        places = F.length(F.regexp_replace(mention, f"(?!{pattern}).", ""))
        rest = F.substring(plain, places + 1, F.length(plain))
        return F.concat(F.array_join(F.transform(F.split(mention, ""), lambda c, i: F.when(
            c.rlike(pattern), F.substring(plain, F.length(F.regexp_replace(
                F.substring(mention, F.lit(1), i + 1), f"(?!{pattern}).", "")), F.lit(1))).otherwise(c)), ""), rest)

    def cased(body: Column) -> Column:
        """Word by word in the mention's case, where the lengths agree."""
        def word(old: Column, new: Column) -> Column:
            letters = F.zip_with(F.split(old, ""), F.split(new, ""), lambda x, y: F.when(
                x != F.lower(x), F.upper(y)).otherwise(y))
            return F.when(F.length(old) == F.length(new), F.array_join(letters, "")).otherwise(F.initcap(new))
        return F.array_join(F.zip_with(F.split(body, " "), F.split(plain, " "), word), " ")

    whole = F.when((mention == F.upper(mention)) & (mention != F.lower(mention)), F.upper(plain)).otherwise(plain)
    return (F.when(kind.isin(*DIGITS), fill(r"\d")).when(kind == "account", fill(r"[A-Z0-9]"))
            .when(kind.startswith("name"), F.concat(
                F.regexp_extract(mention, _ADDRESS, 0), cased(F.regexp_replace(mention, _ADDRESS, ""))))
            .otherwise(whole))


def dictionary(mentions: DataFrame, key: str) -> DataFrame:
    """A surrogate for each ``kind`` and ``canonical``, distinct and new to the corpus."""
    entities = staged(mentions.where("kind is not null").select("kind", "canonical").distinct(), "entities")
    now = entities.withColumn("attempt", F.lit(0))
    # This ends: each draw after the first ones is from ten times as many surrogates or more.
    while True:
        drawn = staged(now.withColumn(
            "surrogate", surrogate(F.col("kind"), F.col("canonical"), F.col("attempt"), key)), "surrogates")
        same = Window.partitionBy("kind", "surrogate").orderBy("attempt", "canonical")
        taken = entities.select("kind", F.col("canonical").alias("surrogate"), F.lit(True).alias("taken"))
        checked = staged(drawn.withColumn("place", F.row_number().over(same)).join(
            taken, ["kind", "surrogate"], "left"), "checked")
        clash = (F.col("place") > 1) | F.col("taken").isNotNull()
        if checked.where(clash).isEmpty():
            return checked.select("kind", "canonical", "surrogate")
        now = checked.select("kind", "canonical", (F.col("attempt") + clash.cast("int")).alias("attempt"))


def replaced(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with surrogates in the column ``text``, and the two columns ``kinds`` and ``n_found``.

    All other columns are kept, whatever their names; ``kinds`` and ``n_found`` are placed last.
    """
    text = F.col("_row.text").cast("string")
    rows = docs.select(F.struct(*docs.columns).alias("_row"))
    held = F.coalesce(text.rlike(HINT) & text.rlike(ANY), F.lit(False))
    # The mentions of each text once, however many rows have it. Two texts that shared a hash would
    # only share the union of their mentions.
    texts = rows.select(F.xxhash64(text).alias("_key"), found(text).alias("mentions")).where(F.size("mentions") > 0)
    mentions = texts.select("_key", F.explode(F.array_distinct("mentions")).alias("mention")).distinct()
    kind = F.col("kind")
    mentions = staged(mentions.withColumn("kind", kind_of(F.col("mention"))).withColumn(
        "canonical", canonical(kind, F.col("mention"))), "mentions")
    # What is no entity after all stands for itself.
    table = mentions.join(dictionary(mentions, key), ["kind", "canonical"], "left").withColumn("new", F.coalesce(
        rendered(kind, F.col("mention"), F.col("surrogate")), F.col("mention")))
    maps = table.groupBy("_key").agg(
        F.map_from_entries(F.collect_list(F.struct("mention", F.struct("new", "kind")))).alias("_map"))

    names = [n for n in docs.columns if n not in ("kinds", "n_found")]

    def output(new_text: Column, kinds: Column) -> list[Column]:
        columns = [(new_text if n == "text" else F.col(f"_row.`{n}`")).alias(n) for n in names]
        return [*columns, kinds.alias("kinds"), F.size(kinds).cast("long").alias("n_found")]

    with_data = rows.where(held).withColumn("_key", F.xxhash64(text)).join(maps, "_key").withColumn(
        "_found", F.transform(found(text), lambda m: F.element_at("_map", m))).withColumn(
        "_gaps", F.split(text, ANY, -1))
    pieces = F.zip_with(F.col("_found"), F.slice("_gaps", F.lit(2), F.size("_found")),
                        lambda f, gap: F.concat(f["new"], gap))
    changed = with_data.select(*output(
        F.concat(F.element_at("_gaps", 1), F.array_join(pieces, "")),
        F.array_compact(F.transform("_found", lambda f: f["kind"]))))
    rest = rows.where(~held).select(*output(text, F.array().cast("array<string>")))
    return changed.unionByName(rest)

"""Personal data replaced by surrogates.

Entities are found by one pattern, and each gets a replacement drawn by a keyed hash from its
canonical form: the same entity gets the same surrogate in every document and in every way of writing it,
and nobody without the key can tell which it was. Digits become digits, letters become letters of the same script
and case, marks stay; addresses of machines have valid numbers; names after a title get a name of that
title's gender in their script, of no gender after a degree alone. Case counts for nothing
in names, e-mails and hexadecimal strings, and 00 before a country is +.

Not found: names without one of the titles listed, inflected titles, initials, particles and hyphenated or apostrophised parts of
names; secrets that are neither quoted after one of four English keywords nor of a known prefix; telephone numbers as plain digits
without + or in other groups than ``_PLAIN_PHONE``; IBANs in small letters; addresses of machines with colons; postal addresses.

Distinctness is checked over the whole corpus: no two entities share a surrogate and no surrogate is
an entity that occurs. Of entities that collide the first stays and the others draw again, until
none is left. What can be drawn grows with the number of the draw, so there is always an end: an invented name gets one more
syllable each time, anything else that keeps its format one more letter or digit after ``GROWS_AFTER`` draws, which only formats
that are nearly used up reach. Addresses of machines alone do not grow; there are 3.7 billion of them. Only canonical forms are shuffled for that, combined in each task first; a document needs no more than
the numbers of draws that are not the first, which are few.

Null text stays null; empty texts and texts without entities stay as they are. Repeated rows get equal
results. Texts are searched whole. An empty table gives an empty result. Extra columns are passed
through by ``replace``, except ``n_entities`` and ``n_by_kind``, which it sets.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strikelens.runtime import stage

KEY = "surrogates-1"
#: Titles by gender, and degrees, which tell none and may follow a title. They are found in capitals as well, and in
#: small letters but for ``CAPITALISED``.
FEMALE = (
    *("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Mlle", "Sra", "Srta", "Señora", "Señorita", "Doña", "Signora", "Dra", "Professorin"),
    *("Госпожа", "Г-жа", "Пани", "Κυρία", "Κα", "Καθηγήτρια"),
)
MALE = (
    *("Mr", "Herr", "Herrn", "Sr", "Señor", "Don", "Monsieur", "Signor"),
    *("Господин", "Г-н", "Пан", "Κύριος", "Κύριο", "Κος", "Καθηγητής"),
)
DEGREES = (
    *("Dr", "Prof", "Professor", "Doctor", "Doktor", "Docteur", "Professeur", "Profesor"),
    *("Доктор", "Д-р", "Проф", "Профессор", "Академик", "Δρ", "Καθ", "Κ"),
)
#: In small letters these are other words.
CAPITALISED = ("Miss", "Ms", "Don", "Пан")


def _any_of(titles: tuple[str, ...]) -> str:
    """A pattern of ``titles`` in the cases in which they are found."""
    small = [t.lower() for t in titles if t not in CAPITALISED]
    return f"(?:{'|'.join(sorted({*titles, *small, *(t.upper() for t in titles)}))})"


#: A title, with the degrees after it; what follows is not a degree.
_HEAD = rf"{_any_of((*FEMALE, *MALE, *DEGREES))}\.? (?:{_any_of(DEGREES)}\.? )*+(?!{_any_of(DEGREES)}(?!\p{{L}}))"
#: What each kind looks like; at one place the first that fits counts. The first ones begin where no letter or digit is before.
#: Groups without a bound are possessive: what gives back takes stack for each repetition.
WORDS = {
    "email": r"(?<![._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)++",
    "iban": r"[A-Z]{2}[0-9]{2}(?:[0-9A-Z]{11,30}|(?: [0-9A-Z]{4}){3,7}(?: [0-9A-Z]{1,3})?)(?![\p{L}\p{N}])",
    "hex": r"[0-9a-fA-F]{32,128}(?![\p{L}\p{N}])",
    "secret": r"(?<!_)(?i:AKIA[0-9A-Z]{16}(?![0-9A-Z])|gh[oprsu]_[0-9A-Z]{30,}|sk-[0-9A-Z]{20,})"
    r"|(?<=(?i:token|secret|key|password)[\"']? ?[=:] ?[\"'])[0-9A-Za-z_+/\-]{12,}(?=[\"'])",
    "name": rf"{_HEAD}\p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?",
}
#: Telephone numbers without + or brackets: three, three and four digits, perhaps after a 1; 00 and a country; 0 and an area.
_PLAIN_PHONE = (
    r"(?:(?:1[ .\-])?[0-9]{3}[ .\-][0-9]{3}[ .\-][0-9]{4}|1[ .\-]?\([0-9]{3}\) ?[0-9]{3}[ .\-][0-9]{4}"
    r"|00[1-9][0-9]{0,2} (?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ \-][0-9]{2,8}){1,4}"
    r"|0[1-9](?: [0-9]{2}){4}|0[1-9][0-9]{1,3} [0-9]{3,4} [0-9]{3,4}|0[1-9][0-9]{1,3}[ /][0-9]{5,8})"
)
_CARD = r"[0-9]{13,19}|[0-9]{4}(?:[ \-][0-9]{4}){3}|[0-9]{4}[ \-][0-9]{6}[ \-][0-9]{5}"
#: These begin with a digit or one of two marks.
NUMBERS = {
    "phone": r"\+[0-9]{1,3}[ .\-]?(?:\([0-9]{1,4}\)|[0-9]{1,4})(?:[ .\-]?[0-9]{2,4}){2,4}(?![0-9])"
    r"|(?<![0-9])\([0-9]{3}\) ?[0-9]{3}[ .\-][0-9]{4}(?![0-9])"
    r"|(?<![0-9.\-])[0-9]{3}[.\-][0-9]{3}[.\-][0-9]{4}(?![0-9.\-])"
    rf"|(?<![0-9.\-/])(?<![0-9] ){_PLAIN_PHONE}(?![0-9\-]|[ .,][0-9])",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])",
    "national": r"(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "card": rf"(?<![0-9])(?:{_CARD})(?![0-9])",
}
KINDS = (*WORDS, *NUMBERS)
#: After so many draws what keeps its format gets longer.
GROWS_AFTER = 6
#: Letters by script and case, and the hexadecimal digits.
LETTERS = {
    "0-9": "0123456789",
    "a-z": "abcdefghijklmnopqrstuvwxyz",
    "A-Z": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "à-öø-þ": "àáâäçèéêëìíîïñòóôöùúûü",
    "À-ÖØ-Þ": "ÀÁÂÄÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ",
    "а-яё": "абвгдежзийклмнопрстуфхцчшщыэюя",
    "А-ЯЁ": "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЫЭЮЯ",
    "ά-ώ": "αβγδεζηθικλμνξοπρστυφχψω",
    "ΆΈ-ΊΌΎΏΑ-Ϋ": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
}
HEXADECIMAL = "0123456789abcdef"
#: Syllables and endings of invented names, by script: Latin, Cyrillic, Greek.
SYLLABLES = (
    "ba be bi bo bra ca ce co da de di do dra el en fa fe fi ga ge gi go ha he hi jo ka ke la le li lo ma me mi mo na ne ni no "
    "pa pe ra re ri ro sa se si so ta te ti to va ve vi za",
    "ба бе би бо ва ве ви га го да де до жа за ка ки ла ле ли ма ми на не ни но па ра ре ри ро са се та те ти фа хо",
    "βα βε γα γε δα δε δι ζα θε κα κε λα λε λι μα με μι να νε νι πα πε ρα ρε ρι σα σε τα τε τι φα φι",
)
ENDINGS = {"female": ("na", "на", "να"), "male": ("ron", "рон", "ρος"), "neither": ("lin", "лин", "λιν")}

_ANY = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(WORDS.values())})|(?=[+(0-9])(?:{'|'.join(NUMBERS.values())})"
#: A text with none of these, which is quickly seen, has no entity.
_SIGNS = tuple("0123456789@")
#: Words that may stand before an entity or begin one, told by their first letter where it can be.
_WORD_SIGNS = (
    rf"(?=[{''.join(sorted({c for t in (*FEMALE, *MALE, *DEGREES) for c in t[0] + t[0].lower()}))}])(?<![\p{{L}}\p{{N}}])"
    rf"{_any_of((*FEMALE, *MALE, *DEGREES))}\.? \p{{Lu}}|(?=[AGSTKPagstkp])(?i:akia|gh[oprsu]_|sk-|(?:token|secret|key|password)[\"']? ?[=:])"
)


def kind_of(entity: Column) -> Column:
    """The kind of a found entity. Only marks tell, since what stood around it is gone."""
    chosen = F.lit("secret")
    tests = {
        "hex": entity.rlike("^[0-9a-fA-F]{32,128}$"),
        "card": entity.rlike(rf"^(?:{_CARD})$"),
        "iban": entity.rlike("^[A-Z]{2}[0-9]{2}[0-9A-Z ]{11,}$"),
        "national": entity.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"),
        "phone": entity.rlike(rf"^(?:[+(]|{_PLAIN_PHONE}$)"),
        "ip": entity.rlike(r"^(?:[0-9]{1,3}\.){3}[0-9]{1,3}$"),
        "name": entity.rlike(rf"^{_HEAD}"),
        "email": entity.contains("@"),
    }
    for kind, test in tests.items():
        chosen = F.when(test, kind).otherwise(chosen)
    return chosen


def canonical(entity: Column, kind: Column) -> Column:
    """What all ways of writing an entity have in common."""
    name = F.regexp_replace(entity, rf"^{_HEAD}", "")
    gender = F.when(_has_title(entity, FEMALE), "f ").when(_has_title(entity, MALE), "m ").otherwise("n ")
    digits = F.regexp_replace(entity, "[^0-9]", "")
    return (
        F.when(kind.isin("email", "hex"), F.lower(entity))
        .when((kind == "phone") & _is_abroad(entity), F.concat(F.lit("+"), F.regexp_replace(digits, "^00", "")))
        .when(kind.isin("phone", "card", "national"), digits)
        .when(kind == "iban", F.regexp_replace(entity, " ", ""))
        .when(kind == "name", F.concat(gender, F.lower(name)))
        .otherwise(entity)
    )


def _has_title(entity: Column, titles: tuple[str, ...]) -> Column:
    return entity.rlike(rf"^{_any_of(titles)}\.? ")


def _is_abroad(entity: Column) -> Column:
    """Whether a telephone number begins with the country: after +, after 00, or 1 before ten digits."""
    return entity.rlike(r"^(?:\+|00|1[^0-9]*(?:[0-9][^0-9]*){10}$)")


def _stream(kind: Column, canon: Column, draw: Column, key: str) -> Column:
    """256 hexadecimal digits that only the key's holder can foresee."""
    message = F.concat_ws("|", F.lit(key), kind, draw.cast("string"), canon)
    inner = F.sha2(message, 256)
    return F.concat(F.sha2(F.concat(F.lit(key + "a"), inner), 512), F.sha2(F.concat(F.lit(key + "b"), inner), 512))


def _number(stream: Column, k: Column, below: int) -> Column:
    return (F.conv(F.substr(stream, (k % 63) * 4 + 1, F.lit(4)), 16, 10).cast("int") % below).cast("int")


def _pick(stream: Column, k: Column, letters: str) -> Column:
    return F.substr(F.lit(letters), _number(stream, k, len(letters)) + 1, F.lit(1))


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated(n: Column, one: Callable[[Column], Column]) -> Column:
    """``one`` of 1 to ``n``, joined; empty if ``n`` is less than 1."""
    return F.when(n > 0, F.array_join(F.transform(F.sequence(F.lit(1), n), one), "")).otherwise("")


def _in_format(entity: Column, kind: Column, stream: Column, draw: Column) -> Column:
    """Every letter and digit anew, by its place among letters and digits, so that marks between them change nothing.

    Late draws add letters or digits at the end, or before the @.
    """
    top = F.length(F.regexp_extract(entity, r"\.[^.]*$", 0))
    fixed_end = F.when(kind == "email", F.length(entity) - top).otherwise(F.length(entity))
    keeps_first = (kind == "card") | ((kind == "phone") & (_is_abroad(entity) | entity.startswith("0")))
    # 00 stands for +
    before = F.when((kind == "phone") & entity.startswith("00"), 2).otherwise(0)
    shouted = entity.rlike("[A-F]") & ~entity.rlike("[a-f]")

    def letter(i: Column) -> Column:
        own = F.substr(entity, i, F.lit(1))
        k = F.length(F.regexp_replace(F.substr(entity, F.lit(1), i), r"[^\p{L}\p{N}]", "")) - 1 - before
        hexadecimal = _pick(stream, k, HEXADECIMAL)
        new = F.when(kind == "hex", F.when(shouted | own.rlike("[A-F]"), F.upper(hexadecimal)).otherwise(hexadecimal))
        for characters, letters in LETTERS.items():
            new = new.when(own.rlike(f"^[{characters}]$"), _pick(stream, k, letters))
        stays = (i > fixed_end) | (keeps_first & (k <= 0)) | ~own.rlike(r"^[\p{L}\p{N}]$")
        # letters and digits of other scripts become Latin ones
        other = (
            F.when(own.rlike(r"^\p{N}$"), _pick(stream, k, LETTERS["0-9"]))
            .when(own.rlike(r"^\p{Lu}$"), _pick(stream, k, LETTERS["A-Z"]))
            .otherwise(_pick(stream, k, LETTERS["a-z"]))
        )
        return F.when(stays, own).otherwise(F.coalesce(new, other))

    def more(j: Column) -> Column:
        k = F.lit(63) - j
        digit = _pick(stream, k, LETTERS["0-9"])
        return F.when(kind.isin("email", "secret"), _pick(stream, k, LETTERS["a-z"])).otherwise(digit)

    made = F.array_join(F.transform(F.sequence(F.lit(1), F.length(entity)), letter), "")
    cut = F.when(kind == "email", F.instr(entity, "@") - 1).otherwise(F.length(entity))
    grown = F.concat(F.substr(made, F.lit(1), cut), _repeated(draw - GROWS_AFTER, more), F.substr(made, cut + 1))
    return F.when(draw > GROWS_AFTER, grown).otherwise(made)


def _machine(stream: Column) -> Column:
    first = _number(stream, F.lit(0), 223) + 1
    return F.concat_ws(".", first, *[_number(stream, F.lit(k), 256) for k in (1, 2, 3)])


def _invented(stream: Column, words: Column, female: Column, male: Column, script: Column, draw: Column) -> Column:
    """As many names as ``words``: of the gender first, with a syllable more for each draw, then of no gender."""

    def one(i: Column) -> Column:
        made = []
        for s, syllables in enumerate(SYLLABLES):
            all_of = F.split(F.lit(syllables), " ")
            part = lambda k: F.get(all_of, _number(stream, i * 3 + k, len(syllables.split())))  # noqa: B023, E731
            ending = F.when(female, ENDINGS["female"][s]).when(male, ENDINGS["male"][s]).otherwise(ENDINGS["neither"][s])
            more = _repeated(draw, lambda j: F.get(all_of, _number(stream, F.lit(63) - j, len(syllables.split()))))  # noqa: B023
            made.append(F.concat(part(0), part(1), F.when(i == 0, F.concat(more, ending)).otherwise(part(2))))
        return F.initcap(F.when(script == 1, made[1]).when(script == 2, made[2]).otherwise(made[0]))

    return F.array_join(F.transform(F.sequence(F.lit(0), words - 1), one), " ")


def surrogate(entity: Column, kind: Column, canon: Column, draw: Column, key: str = KEY) -> Column:
    return _bound(_stream(kind, canon, draw, key), lambda stream: _drawn(entity, kind, stream, draw))


def _drawn(entity: Column, kind: Column, stream: Column, draw: Column) -> Column:
    name = F.regexp_replace(entity, rf"^{_HEAD}", "")
    title = F.substr(entity, F.lit(1), F.length(entity) - F.length(name))
    words = F.size(F.split(name, " "))
    script = F.when(name.rlike("[А-Яа-я]"), 1).when(name.rlike("[Α-Ωα-ω]"), 2).otherwise(0)
    invented = _invented(stream, words, _has_title(entity, FEMALE), _has_title(entity, MALE), script, draw)
    person = F.concat(title, F.when(name == F.upper(name), F.upper(invented)).otherwise(invented))
    return F.when(kind == "ip", _machine(stream)).when(kind == "name", person).otherwise(_in_format(entity, kind, stream, draw))


def _found() -> Column:
    """The entities in ``text``, in order."""
    some = reduce(or_, [F.col("text").contains(sign) for sign in _SIGNS]) | F.col("text").rlike(_WORD_SIGNS)
    return F.when(some, F.regexp_extract_all("text", F.lit(_ANY), 0))


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, print (a hash of the text), entity, kind, canon: the entities of each text, each once."""
    found = docs.select("doc_id", F.xxhash64("text").alias("print"), F.explode(F.array_distinct(_found())).alias("entity"))
    return found.withColumn("kind", kind_of(F.col("entity"))).withColumn("canon", canonical(F.col("entity"), F.col("kind")))


def entities(found: DataFrame) -> DataFrame:
    """kind, canon of every entity of ``occurrences``, once."""
    return found.groupBy("kind", "canon").agg(F.min("entity").alias("entity"))


def draws(found: DataFrame, key: str = KEY) -> DataFrame:
    """``found`` with the number of the draw that gives each entity a surrogate of its own, and that surrogate's canonical form."""
    kind, canon = F.col("kind"), F.col("canon")

    def drawn(rows: DataFrame) -> DataFrame:
        new = surrogate(F.col("entity"), kind, canon, F.col("draw"), key)
        return stage(rows.withColumn("new", _bound(new, lambda n: canonical(n, kind))), "draws")

    settled = drawn(found.withColumn("draw", F.lit(0)))
    taken = found.select("kind", F.col("canon").alias("new"), F.lit(True).alias("real"))
    while True:
        first = settled.groupBy("kind", "new").agg(F.min(F.struct("draw", "canon")).alias("first"))
        judged = settled.join(first, ["kind", "new"]).join(taken, ["kind", "new"], "left")
        again = F.col("real").isNotNull() | (F.struct("draw", "canon") != F.col("first"))
        judged = stage(judged.select("kind", "canon", "entity", "draw", "new", again.alias("again")), "judged")
        repeat = judged.filter("again")
        if repeat.isEmpty():
            return settled
        moved = drawn(repeat.select("kind", "canon", "entity", (F.col("draw") + 1).alias("draw")))
        settled = stage(judged.filter(~F.col("again")).select(*moved.columns).unionByName(moved), "settled")


def replace(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in ``text``, and n_entities and n_by_kind, a map."""
    own = stage(occurrences(docs), "occurrences")
    later = stage(draws(stage(entities(own), "entities"), key).filter("draw > 0").select("kind", "canon", "draw"), "later-draws")
    # the parts between entities, of texts that have some
    cut = docs.withColumn("_s_found", _found())
    cut = cut.withColumn("_s_parts", F.when(F.size("_s_found") > 0, F.split("text", _ANY, -1)))
    cut = cut.withColumn(
        "_s_named",
        F.transform("_s_found", lambda e: _bound(kind_of(e), lambda k: F.struct(e.alias("entity"), k.alias("kind"), canonical(e, k).alias("canon")))),
    )
    # the documents whose entities needed a later draw, with those draws
    hit = own.join(later, ["kind", "canon"]).select("doc_id", "print", F.struct(F.concat_ws("|", "kind", "canon"), "draw").alias("hit"))
    by_doc = stage(hit.groupBy("doc_id", "print").agg(F.map_from_entries(F.collect_set("hit")).alias("_s_draws")), "document-draws")
    by_doc = by_doc.select(F.col("doc_id").alias("_s_id"), F.col("print").alias("_s_print"), "_s_draws")
    same = F.col("doc_id").eqNullSafe(F.col("_s_id")) & (F.xxhash64("text") == F.col("_s_print"))
    joined = cut.join(by_doc, same, "left")

    def new(e: Column) -> Column:
        draw = F.coalesce(F.element_at("_s_draws", F.concat_ws("|", e["kind"], e["canon"])), F.lit(0))
        return surrogate(e["entity"], e["kind"], e["canon"], draw, key)

    # no entity, no work
    news = F.when(F.size("_s_named") > 0, F.transform("_s_named", new))
    whole = F.array_join(F.zip_with("_s_parts", news, lambda part, n: F.concat(part, F.coalesce(n, F.lit("")))), "")
    kinds = F.col("_s_named.kind")
    count = lambda kind: F.greatest(F.size(F.filter(kinds, lambda x: x == kind)), F.lit(0))
    by_kind = F.map_from_arrays(F.array(*map(F.lit, KINDS)), F.array(*map(count, KINDS)))
    text = F.when(F.size("_s_named") > 0, whole).otherwise(F.col("text")).alias("text")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_entities", "n_by_kind")]
    return joined.select(*others, text, F.greatest(F.size("_s_named"), F.lit(0)).alias("n_entities"), by_kind.alias("n_by_kind"))

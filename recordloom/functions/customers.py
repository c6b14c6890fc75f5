"""Customer cells of visit and account sheets: name, address, kind of row, owner, company and people in a text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .phones import e164, phone_numbers, placeholder

# Fixed values, which results depend on.
LEGAL = r"股份有限公司|有限公司|Co\.?,?\s*Ltd\.?|Ltd\.?|GmbH"
ADDRESS_MARKS = r"省|市|区|路|号|No\.|Road|District"
ADDRESS_WORDS = r"\b(?:Village|Town|City|Zone|Park|Street|Province|County|Avenue|Lane|Building|Floor|Block)\b"
EXHIBITIONS = r"exhibition|展会|\bexpo\b|\bfair\b|\bmesse\b"
INTERNALS = (
    r"holiday|假期|休息|meeting online|internal meeting|\boffice\b|training|培训|team building"
    r"|^\s*(?:register|upload|get ready|attend|prepare|collect|arrange)\b"
)
GRAMMAR_WORDS = ("the", "a", "an", "to", "for", "in", "on", "at", "with", "from", "by", "is", "are", "be", "will")
HONORIFICS = ("mr", "mrs", "ms", "miss", "dr", "prof", "sir")
VISITS = r"(?:\bvisit(?:ed|ing)?\b(?:\s+to\b)?|\bmeeting\s+with\b|拜访)\s*(.+)"
TOPIC_ENDS = r"\s+and\s|\s*\(|\s+to\s|\s+for\s|,(?!\s*(?:Co|Ltd))|[，；;]"
ROLES = (
    "manager director chairman engineer supervisor technical technology technician production sales general chief senior deputy assistant "
    "president head vice workshop quality purchasing procurement project owner lead ceo cto coo"
)
COMPANY_TAILS = r"\b(?:Co|Ltd|Technology|Machine Tools|GmbH|Inc|Corp|Group|Tools)\b"
_EDGES = " ,;，、()（）"


def _tidy(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"^[\s ]+|[\s ]+$", "")


def _flat(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[\s ]+", " "))


def _bare(text: Column) -> Column:
    return F.btrim(text, F.lit(_EDGES))


def split_customer(cell: Column) -> Column:
    """``name, address, sure`` of a customer cell.

    A line end or a legal form ends the name; a second line that reads like a name
    belongs to it; an address word is a guess, and so is a long cell with neither.
    """
    text = _tidy(cell)
    out = lambda name, address, sure: F.struct(name.alias("name"), address.alias("address"), sure.alias("sure"))
    nothing, yes = F.lit(""), F.lit(True)
    first, rest = F.regexp_extract(text, r"^([^\n]*)\n", 1), _bare(_flat(F.regexp_extract(text, r"(?s)^[^\n]*\n(.*)$", 1)))
    formed = rest.rlike(f"(?i){LEGAL}") & (F.length(F.regexp_extract(rest, f"(?is)^.*?(?:{LEGAL})(.*)$", 1)) <= 1)
    goes_on = (rest != "") & (formed | ~rest.rlike(rf"{ADDRESS_MARKS}|\d"))
    tail = _bare(F.regexp_extract(text, f"(?is)^.*?(?:{LEGAL})(.*)$", 1))
    tail = F.when(F.btrim(tail, F.lit(" .,")).rlike(f"(?i)^(?:{LEGAL})$"), nothing).otherwise(tail)
    guess = rf"(?s)^(.{{6,}}?)((?:{ADDRESS_MARKS}).*)$"
    short = (F.length(text) <= 40) | ((F.length(text) <= 80) & text.contains(" ") & ~text.rlike(r"\d"))
    return (
        F.when(placeholder(text), out(nothing, nothing, yes))
        .when(text.contains("\n") & goes_on, out(F.trim(F.concat_ws(" ", _bare(first), rest)), nothing, yes))
        .when(text.contains("\n"), out(_bare(first), rest, yes))
        .when(text.rlike(f"(?i){LEGAL}"), out(_bare(F.regexp_extract(text, f"(?is)^(.*?(?:{LEGAL}))", 1)), tail, yes))
        .when(text.rlike(guess), out(_bare(F.regexp_extract(text, guess, 1)), _bare(F.regexp_extract(text, guess, 2)), F.lit(False)))
        .otherwise(out(text, nothing, short))
    )


def looks_like_address(text: Column) -> Column:
    return F.coalesce(text.rlike(ADDRESS_MARKS) | text.rlike(f"(?i){ADDRESS_WORDS}") | text.rlike(r"\d"), F.lit(False))


def looks_like_person(text: Column) -> Column:
    """Has a letter, is no date, and is more than a title."""
    s = _tidy(text)
    words = F.filter(F.split(F.lower(s), r"[^\p{L}]+"), lambda w: w != "")
    date = s.rlike(r"^(?:\d{4}[-/.]\d{1,2}[-/.]\d{1,2}|\d{1,2}[-/.]\d{1,2}(?:[-/.]\d{2,4})?)$")
    return s.rlike(r"\p{L}") & ~date & F.exists(words, lambda w: ~w.isin(*HONORIFICS))


def reads_as_sentence(text: Column) -> Column:
    """Two grammar words or more, no legal form and no Chinese letter: written about a customer, not a name."""
    words = F.regexp_extract_all(F.lower(text), F.lit("[a-z]+"), F.lit(0))
    return ~text.rlike(rf"(?i){LEGAL}|[\x{{4e00}}-\x{{9fff}}]") & (F.size(F.filter(words, lambda w: w.isin(*GRAMMAR_WORDS))) >= 2)


def row_kind(cell: Column) -> Column:
    """``exhibition`` or ``internal`` for a row that is no visit to a customer, else empty."""
    text = F.coalesce(cell, F.lit(""))
    return F.when(text.rlike(f"(?i){EXHIBITIONS}"), "exhibition").when(text.rlike(f"(?i){INTERNALS}") | reads_as_sentence(text), "internal").otherwise("")


def visit_state(row: Column, customer_type: Column, filled: Sequence[Column], notes: Column) -> Column:
    """``kind, customer_type, status`` of a visit.

    ``row`` is :func:`row_kind`; ``filled`` are the columns a visit to a customer
    fills (potential, contact, phone, mail): with all of them and the type empty it
    was internal.  ``notes`` is an array of texts.
    """
    t = F.lower(_tidy(customer_type))
    bare = F.lit(True)
    for column in filled:
        bare = bare & (F.coalesce(column.cast("string"), F.lit("")) == "")
    seen = F.when(row.isin("internal", "exhibition"), row).when(t.contains("exhibit"), "exhibition").when(t.startswith("dealer"), "dealer")
    kind = seen.when((t == "") & bare, "internal").otherwise("customer")
    folded = F.when(t.startswith("dealer"), "dealer").when(t.startswith("exist"), "existing").when(t.startswith("new"), "new").otherwise("")
    cancelled = F.coalesce(F.exists(notes, lambda n: F.lower(n).contains("cancel")), F.lit(False))
    status = F.when(kind.isin("internal", "exhibition"), kind).when(cancelled, "cancelled").otherwise("done")
    return F.struct(kind.alias("kind"), folded.alias("customer_type"), status.alias("status"))


def owner_of(cell: Column, people: Sequence[str]) -> Column:
    """The one of ``people`` that a cell means: the whole name, a first name that only one has, or one name inside a text; else empty."""
    text = F.lower(_flat(F.coalesce(cell, F.lit(""))))
    text = F.when(placeholder(text), "").otherwise(text)
    known = F.array(*map(F.lit, people))
    whole = F.filter(known, lambda p: F.lower(p) == text)
    first = F.filter(known, lambda p: F.substring_index(F.lower(p), " ", 1) == text)
    inside = F.filter(known, lambda p: (text != "") & text.contains(F.lower(p)))
    one = lambda found: F.when(F.size(found) == 1, F.get(found, 0))
    return F.coalesce(F.get(whole, 0), one(first), one(inside), F.lit(""))


def owner_in_file_name(path: Column, people: Sequence[str]) -> Column:
    """The person whose whole name stands in a file's name, else whose first name does if nobody shares it."""
    stem = F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*$", "")
    stem = F.trim(F.regexp_replace(F.lower(stem), r"[^\p{L}]+", " "))
    firsts = [p.split()[0].lower() for p in people]
    known = F.array(*[F.struct(F.lit(p).alias("name"), F.lit(f).alias("first"), F.lit(firsts.count(f) == 1).alias("alone")) for p, f in zip(people, firsts, strict=True)])
    full = F.filter(known, lambda p: stem.contains(F.lower(p["name"])))
    some = F.filter(known, lambda p: F.array_contains(F.split(stem, " "), p["first"]))
    one = F.when((F.size(some) == 1) & F.get(some, 0)["alone"], F.get(some, 0)["name"])
    return F.coalesce(F.when(F.size(full) == 1, F.get(full, 0)["name"]), one, F.lit(""))


def topic_company(topic: Column) -> Column:
    """What stands behind "visit to", "meeting with" or 拜访, up to the next clause."""
    said = F.regexp_extract(F.coalesce(topic, F.lit("")), f"(?i){VISITS}", 1)
    return F.btrim(_flat(F.get(F.split(said, f"(?i){TOPIC_ENDS}", 2), 0)), F.lit(" .,;，、"))


def role_company(role: Column) -> Column:
    """The company in a role: behind "of", else what is left behind the words of the role if it ends like a company."""
    text = _flat(F.coalesce(role, F.lit("")))
    roles = "|".join(ROLES.split())
    rest = F.btrim(F.regexp_replace(text, rf"(?i)^(?:(?:{roles})[.,]*\s+(?=\S))+", ""), F.lit(" ,;"))
    behind = F.btrim(F.regexp_extract(text, r"(?i)^.*\s+of\s+(.*)$", 1), F.lit(" .,;"))
    return F.when(text.rlike(r"(?i)\S\s+of\s"), behind).when(rest.rlike(f"(?i){COMPANY_TAILS}"), rest).otherwise("")


def account_numbers(cell: Column) -> Column:
    """``numbers, texts`` of an account's phone cell.

    Several numbers may be split by ``/ , ; 、`` or a line end; one to three digits
    behind a slash are the end of a second number and stay with the first as text.
    An extension or a word behind a number places it and keeps the text as well; what cannot
    be placed is text alone.  400 and 800 service lines count as Chinese numbers.
    """
    text = F.regexp_replace(F.coalesce(cell, F.lit("")), r"[A-Za-z0-9._%+'-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", " ")
    text = F.translate(text, "‐‑‒–—―−", "-------")
    parts = F.filter(F.split(text, r"[/,;、\n]"), lambda p: ~p.rlike(r"^\s*$"))
    entry = lambda group, shown: F.struct(group.alias("g"), shown.alias("shown"))
    start = F.array().cast("array<struct<g: string, shown: string>>")

    def step(done: Column, part: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        longer = F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(entry(last["g"], F.concat_ws("/", last["shown"], F.trim(part)))))
        more = F.transform(phone_numbers(part), lambda g: entry(F.trim(g), F.trim(g)))
        return F.when((F.size(done) > 0) & part.rlike(r"^\s*\d{1,3}\s*$"), longer).otherwise(F.concat(done, more))

    def bound(value: Column, body) -> Column:
        # Worked out once, however often the body asks for it.
        return F.get(F.transform(F.array(value), body), 0)

    def placed(token: Column) -> Column:
        digits = F.regexp_replace(token, r"[\s\-().]", "")
        service = F.when(digits.rlike(r"^[48]00\d{7}$"), F.concat(F.lit("+86"), digits))
        return bound(e164(token, lambda text, then: bound(text, then)), lambda n: F.when(n.rlike(r"^\+\d{8,15}$"), n).otherwise(service))

    def read(e: Column) -> Column:
        filled = lambda c: F.get(F.filter(F.array(c), lambda x: x != ""), 0)
        rest = F.coalesce(filled(F.regexp_extract(e["g"], r"^(.*\d)\s*[^\d\s+\-/.].*$", 1)), e["g"])
        # The cell as it is, without a word behind it, without an extension: the first that places it; the later ones are only looked at where the earlier do not.
        behind = bound(rest, lambda r: F.coalesce(placed(r), placed(filled(F.regexp_extract(r, r"^(.*\d)\s*-\s*\d{1,5}$", 1)))))

        def told(n: Column) -> Column:
            clean = n.isNotNull() & (e["shown"] == e["g"])
            return F.struct(F.coalesce(n, behind).alias("number"), F.when(~clean, e["shown"]).alias("text"))

        return bound(placed(e["g"]), told)

    def both(found: Column) -> Column:
        numbers = F.array_distinct(F.array_compact(F.transform(found, lambda x: x["number"])))
        return F.struct(numbers.alias("numbers"), F.array_compact(F.transform(found, lambda x: x["text"])).alias("texts"))

    return bound(F.transform(F.aggregate(parts, start, step), read), both)


def kept_names(text: Column, own: Sequence[str]) -> Column:
    """A text without the names of one's own company, in any case."""
    out = F.coalesce(text, F.lit(""))
    for name in own:
        out = F.regexp_replace(out, "(?i)" + "".join(rf"\{c}" if not c.isalnum() and not c.isspace() else c for c in name), " ")
    return _flat(out)


def name_shape(name: Column) -> Column:
    """``han`` for two to four Chinese letters, ``latin`` for words with capitals, else empty."""
    s = _tidy(name)
    return F.when(s.rlike(r"^[\x{4e00}-\x{9fff}]{2,4}$"), "han").when(s.rlike(r"^\p{Lu}[\p{L}'’.-]+(?:\s+\p{Lu}[\p{L}'’.-]*){1,3}$"), "latin").otherwise("")


def task_notes(notes: Column) -> Column:
    """Of an array of ``text, highlighted, deadline`` those worth a task: highlighted or dated, and not cancelled."""
    return F.filter(notes, lambda n: (F.coalesce(n["highlighted"], F.lit(False)) | n["deadline"].isNotNull()) & ~F.coalesce(F.lower(n["text"]).contains("cancel"), F.lit(False)))


def only_letters_left(text: Column, taken: Column) -> Column:
    """Letters and digits of ``text`` that ``taken`` does not account for, each as often as it is left over, in the order of the alphabet."""
    letters = lambda c: F.filter(F.split(F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}\p{N}]", "")), ""), lambda x: x != "")
    # The nth of a letter goes if the other text has n of them.
    both = lambda c: F.transform(letters(c), lambda x, k: F.concat(x, F.size(F.filter(F.slice(letters(c), F.lit(1), k + 1), lambda y: y == x)).cast("string")))
    return F.array_join(F.array_sort(F.transform(F.array_except(both(text), both(taken)), lambda x: F.substring(x, 1, 1))), "")

"""Text normalisers as Column functions; each has its own fold, and they don't mix."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Sequence
from functools import lru_cache, reduce
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


HANGUL = (0xAC00, 0xD7A3)
#: Code points beyond these planes decompose into nothing and are no marks.
DECOMPOSING = (range(HANGUL[0]), range(HANGUL[1] + 1, 0xD800), range(0xF900, 0x20000), range(0x2F800, 0x2FA20), range(0xE0100, 0xE01F0))


@lru_cache
def _fold_table(marks: str | None) -> tuple[str, str, dict[str, str]]:
    """On two levels: letters that become one letter (or, at the end of the first string, nothing), and those that become several.

    From canonical decompositions without what is in `marks`, or without all nonspacing marks.
    """
    one, gone, many = {}, [], {}
    for c in map(chr, chain(*DECOMPOSING)):
        if unicodedata.decomposition(c) or unicodedata.combining(c) or unicodedata.category(c) == "Mn":
            left = "".join(d for d in unicodedata.normalize("NFD", c) if (d not in marks if marks else unicodedata.category(d) != "Mn"))
            if not left:
                gone.append(c)
            elif left != c:
                (one if len(left) == 1 else many)[c] = left
    return "".join([*one, *gone]), "".join(one.values()), many


def _jamo(c: Column) -> Column:
    """A Hangul syllable as the two or three letters that it is made of."""
    at = F.ascii(c) - HANGUL[0]
    letter = lambda first, count, n: F.element_at(F.array(*[F.lit(chr(first + k) if first + k != 0x11A7 else "") for k in range(count)]), n.cast("int") + 1)
    return F.concat(letter(0x1100, 19, F.floor(at / 588)), letter(0x1161, 21, F.floor(at % 588 / 28)), letter(0x11A7, 28, at % 28))


def _class(letters: Iterable[str]) -> str:
    """The letters for a character class, neighbours as ranges: a class is as slow as it is long."""
    runs: list[list[int]] = []
    for c in sorted(map(ord, letters)):
        if runs and c == runs[-1][1] + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"{chr(a)}-{chr(b)}" for a, b in runs)


def _folded(x: Column, marks: str | None = None) -> Column:
    """Canonical decomposition without marks; only texts with such letters take the way of those that become several."""
    letters, to, many = _fold_table(marks)
    plain = F.translate(x, letters, to)
    several = F.create_map(*[F.lit(v) for pair in many.items() for v in pair])
    syllable = f"[{chr(HANGUL[0])}-{chr(HANGUL[1])}]"
    each = F.transform(F.split(plain, ""), lambda c: F.when(c.rlike(syllable), _jamo(c)).otherwise(F.coalesce(several[c], c)))
    there = sorted([*map(ord, many), *HANGUL])
    rare = f"[{chr(there[0])}-{chr(there[-1])}&&[{_class(many)}{chr(HANGUL[0])}-{chr(HANGUL[1])}]]"  # the bounds first, which most letters are outside of
    folded = F.when(plain.rlike(rare), F.array_join(each, "")).otherwise(plain)
    return F.when(x.rlike(r"[^\x00-\x7F]"), folded).otherwise(x)


def fold_accents(x: Column) -> Column:
    """Letters of all scripts without their marks: canonical decomposition without nonspacing marks."""
    return _folded(x)


def search_fold(x: Column) -> Column:
    """What search compares: lower case first, then decomposed, without marks U+0300 to U+036F."""
    return _folded(F.lower(x), "".join(map(chr, range(0x300, 0x370))))


def compress_alnum(x: Column) -> Column:
    """Upper case, folded, A-Z and 0-9 only."""
    return F.regexp_replace(F.upper(fold_accents(x)), "[^A-Z0-9]", "")


def without_parens(x: Column) -> Column:
    return F.regexp_replace(x, r"\([^)]*\)", "")


def compress_bare(x: Column) -> Column:
    """compress_alnum() of what stands outside parentheses."""
    return compress_alnum(without_parens(x))


def compress_alpha(x: Column) -> Column:
    """Upper case, folded, A-Z only."""
    return F.regexp_replace(F.upper(fold_accents(x)), "[^A-Z]", "")


#: Digits that scanners read for letters; fixed values.
LOOKALIKES_UPPER = ("10584", "IOSBA")
LOOKALIKES_LOWER = {"1": "i", "0": "o", "5": "s", "8": "b"}


def compressed_lemma(x: Column) -> Column:
    """compress_alnum() with digits as the letters that they look like."""
    return F.translate(compress_alnum(x), *LOOKALIKES_UPPER)


def link_key(x: Column) -> Column:
    """A key that survives misread digits in words and b written for v; what stands in brackets doesn't count."""
    x = fold_accents(F.lower(F.trim(x)))
    x = F.regexp_replace(F.regexp_replace(x, r"\([^)]*\)", " "), r"\[[^\]]*\]", " ")
    for digit, letter in LOOKALIKES_LOWER.items():
        x = F.regexp_replace(x, rf"(?<=[a-z]){digit}(?=[a-z]|$)", letter)
    x = F.translate(x, "v", "b")
    return F.trim(F.regexp_replace(F.regexp_replace(x, "[^a-z0-9 ]", " "), r"\s+", " "))


#: Articles that may lead a name, as written; fixed values.
ARTICLES = ("S'", "s'", "L'", "l'", "es ", "Es ", "ES ", "sa ", "Sa ", "SA ", "el ", "El ", "EL ", "la ", "La ", "LA ", "els ", "Els ", "ELS ", "les ", "Les ", "LES ", "ses ", "Ses ", "SES ", "sos ", "Sos ", "SOS ", "so ", "So ", "na ", "Na ", "en ", "En ", "n'", "N'")
#: Capitalised ones that are lowered at the head of a name, and signs that a place-name key hasn't; fixed values.
LOWERED_ARTICLES = ("Es ", "Sa ", "El ", "La ", "Els ", "Les ")
KEY_SIGNS = ".,;:¡¿!?()[]{}«»\"'`"


def gaz_norm(x: Column) -> Column:
    """A place-name key: no leading article (as written), folded, upper case, dashes and slashes as spaces, listed signs deleted."""
    x = F.regexp_replace(F.trim(x), f"^(?:{'|'.join(ARTICLES)})", "")
    x = F.regexp_replace(F.upper(fold_accents(x)), "[-/\u2013\u2014]", " ")
    return F.trim(F.translate(collapse(x), KEY_SIGNS, ""))


def article_lower(x: Column) -> Column:
    """A leading capitalised article in lower case."""
    head = F.regexp_extract(x, f"^(?:{'|'.join(LOWERED_ARTICLES)})", 0)
    return F.concat(F.lower(head), F.substring(x, F.length(head) + 1, F.length(x)))


#: What may stand in a name's parenthesis, as a pattern of its start, and the heads under which the name is then listed; fixed values.
TURNED_HEADS = ((r"(?:[Ss]on|SON|so|SO|[Cc]an|CAN)\)", ("SON", "CA")), ("cabo", ("CABO", "CAP")), ("cala", ("CALA",)))
#: A name's first word, and the words that it is also listed under; fixed values.
SWAPPED_HEADS = (("CAS", ("CAS", "CA", "CAN")), ("CA", ("CA", "CAN", "CANA")))


def name_variants(x: Column, synonyms: dict[str, str], turned_heads: Sequence[tuple[str, Sequence[str]]] = TURNED_HEADS, swapped_heads: Sequence[tuple[str, Sequence[str]]] = SWAPPED_HEADS) -> Column:
    """Spellings a name may be listed under: as is, without its parenthesis, parenthesis first, words by synonyms, with the heads that its parenthesis stands for and those that its first word swaps with; sorted, distinct."""
    bare = F.trim(F.regexp_replace(F.regexp_replace(x, r"\([^)]*\)", " "), " +", " "))
    inner = F.regexp_extract(x, r"\(([^)]*)\)", 1)
    turned = F.when(inner != "", F.concat_ws(" ", inner, bare))
    table = F.create_map(*[F.lit(v) for pair in synonyms.items() for v in pair]) if synonyms else None
    mapped = F.array_join(F.transform(F.split(bare, " "), lambda w: F.coalesce(table[w], w)), " ") if synonyms else bare
    keys = [compress_alpha(v) for v in (x, bare, turned, mapped)]
    before = compress_alpha(F.substring_index(x, "(", 1))
    for inside, heads in turned_heads:
        keys += [F.when(x.rlike(rf"^[^(]*[^(\s]\s*\((?:{inside})") & (before != ""), F.concat(F.lit(h), before)) for h in heads]
    upper = F.upper(fold_accents(x))
    for word, heads in swapped_heads:
        rest = F.regexp_extract(upper, rf"^{word}\s+([A-Z]{{2,}})", 1)
        keys += [F.when(rest != "", F.concat(F.lit(h), rest)) for h in heads]
    return F.array_sort(F.array_distinct(F.filter(F.array(*keys), lambda v: v.isNotNull() & (v != ""))))


def collapse(x: Column) -> Column:
    return F.trim(F.regexp_replace(x, r"[\s]+", " "))


def join_hyphens(x: Column) -> Column:
    """Hyphens within words closed up; matches don't overlap, so `a-b-c` becomes `ab-c`."""
    return F.regexp_replace(x, "(?U)(\\w)-(\\w)", "$1$2")


def join_hyphens_spaced(x: Column) -> Column:
    """Hyphens within words closed up, also before white space."""
    return F.regexp_replace(x, "(?U)(\\w)-\\s*(\\w)", "$1$2")


def join_broken_words(x: Column) -> Column:
    """Only a hyphen and white space between lower-case letters."""
    return F.regexp_replace(x, "(\\p{Ll})-\\s+(\\p{Ll})", "$1$2")


def split_particle(x: Column, particle: str, keyword: str) -> Column:
    """A particle glued to a keyword gets its space back."""
    return F.regexp_replace(x, rf"(?iU)\b({particle})({keyword})", "$1 $2")


def clean_lead(x: Column, noise: str = "[*#|~^]", glyphs: tuple[str, str] = ("çñ", "ÇÑ")) -> Column:
    """The first word, which ends at white space, a parenthesis or a hyphen, without symbols and its tolerated glyphs in upper case; the rest as it is."""
    head = F.regexp_extract(x, r"^[^\s()-]*", 0)
    return F.concat(F.translate(F.regexp_replace(head, noise, ""), *glyphs), F.substring(x, F.length(head) + 1, F.length(x)))


def strip_trailer(x: Column, note: str) -> Column:
    """Without a closing note and without closing punctuation."""
    return F.regexp_replace(F.regexp_replace(x, rf"\s*{note}\s*$", ""), r"[\s.,;:]+$", "")


def excerpt(x: Column, most: int = 320, least: int = 220) -> Column:
    """At most `most` characters, cut at the last space after `least`, without one closing comma, semicolon or colon, with an ellipsis."""
    head = F.substring(x, 1, most)
    space = F.length(head) - F.instr(F.reverse(head), " ") + 1
    cut = F.when((F.instr(head, " ") > 0) & (space - 1 > least), F.substring(head, F.lit(1), space - 1)).otherwise(head)
    return F.when(F.length(x) <= most, x).otherwise(F.concat(F.regexp_replace(cut, r"[,;:]\s*$", ""), F.lit("…")))


def html_escape(x: Column) -> Column:
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        x = F.replace(x, F.lit(raw), F.lit(safe))
    return x


def compact_number(x: Column) -> Column:
    """Thousands as K, millions as M, with one decimal."""
    tenths = lambda unit: (F.round(x.cast("decimal(30,6)") / unit, 1)).cast("decimal(20,1)").cast("string")
    return F.when(F.abs(x) >= 1_000_000, F.concat(tenths(1_000_000), F.lit("M"))).when(F.abs(x) >= 1000, F.concat(tenths(1000), F.lit("K"))).otherwise(tenths(1))


def grouped_number(x: Column, decimals: int = 0, group: str = ".", point: str = ",") -> Column:
    """Thousands grouped and a fixed number of decimals, with the signs of a locale."""
    return F.translate(F.format_number(x, decimals), ",.", group + point)


def snippet(x: Column, needle: str, before: int = 30, after: int = 150) -> Column:
    """What stands around the first match, line breaks as a spaced bar; null without a match."""
    at = F.instr(x, needle)
    start = F.greatest(at - before, F.lit(1))
    return F.when(at > 0, F.replace(F.substring(x, start, at + after - start), F.lit("\n"), F.lit(" | ")))


def bullet_section(title: str, items: Column) -> Column:
    """A titled list, an item a line; null items are left out."""
    return F.concat_ws("\n", F.lit(title), F.array_join(F.transform(F.filter(items, lambda v: v.isNotNull()), lambda v: F.concat(F.lit("- "), v)), "\n"))

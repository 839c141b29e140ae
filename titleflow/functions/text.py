"""Tokenisers as native Spark expressions.

All are plain ``regexp_replace`` / ``split`` / ``regexp_extract_all``
chains, so they stay inside whole-stage codegen and can be applied to batch
and streaming DataFrames alike. The patterns only use constructs that Java
regex and RE2 (DuckDB) read the same way, which is what lets the DuckDB
oracle run the identical rules.
"""

from __future__ import annotations

from functools import partial, reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.split()`` treats as
# whitespace, written as one regex class valid in Java and RE2.
WHITESPACE_CLASS = r"[\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]"

# The "basic_english" normalisation of the title tokeniser,
# applied in this order after lower-casing (pattern, replacement).
BASIC_ENGLISH_RULES = [
    (r"'", " '  "),
    (r'"', ""),
    (r"\.", " . "),
    (r"<br \/>", " "),
    (r",", " , "),
    (r"\(", " ( "),
    (r"\)", " ) "),
    (r"\!", " ! "),
    (r"\?", " ? "),
    (r"\;", " "),
    (r"\:", " "),
    (r"\s+", " "),
]


def basic_english_rules() -> list[tuple[str, str]]:
    """The fixed rule table, for tests and for the DuckDB oracle."""
    return list(BASIC_ENGLISH_RULES)


# The twelve rules above fused into two replacements of fixed strings and one
# pass that reads the tokens off. Rules 1, 3 and 5-9 make one character a
# token of its own, rules 10-12 only separate; quotes and line breaks go
# first, as none of the other rules can create or break one (checked against
# the sequential Python version on whole documents in the tests).
_SINGLE = "'.,()!?"
_BASIC_TOKEN = rf"[{_SINGLE}]|[^{_SINGLE};:{WHITESPACE_CLASS[1:-1]}]+"
_BASIC_BLANK = rf"[;:{WHITESPACE_CLASS[1:-1]}]*"


def tokenize_basic(title: Column | str, first: int | None = None) -> Column:
    """Lower-case and split a title with the basic_english rules.

    Returns ``array<string>``; an empty or all-punctuation-free blank title
    gives an empty array; NULL stays NULL. With ``first`` only that many
    tokens are read off, from the start of the text that holds them.
    """
    t = F.col(title) if isinstance(title, str) else title
    t = F.lower(t)
    t = F.replace(F.replace(t, F.lit('"'), F.lit("")), F.lit("<br />"), F.lit(" "))
    if first is not None:
        t = F.regexp_extract(t, rf"^(?:{_BASIC_BLANK}(?:{_BASIC_TOKEN})){{0,{int(first)}}}", 0)
    return F.regexp_extract_all(t, F.lit(_BASIC_TOKEN), 0)


# Word tokeniser used by ``clean`` (re-aimed Treebank-style splitting):
#   * a word is a run of letters, digits, marks or '_' with inner hyphens
#     and at most one trailing hyphen ("well-known", "oVer-");
#   * an apostrophe starts a clitic token ("It's" -> "It", "'s";
#     "don't" -> "don", "'t"); Treebank gives "do", "n't" instead;
#   * any other non-space character is a token of its own ("d[o]g." ->
#     "d", "[", "o", "]", "g", ".").
_W = r"[\p{L}\p{N}\p{M}_]"
WORD_PATTERN = (
    _W + r"+(?:-" + _W + r"+)*-?"
    + r"|'" + _W + r"+"
    + r"|[^\p{L}\p{N}\p{M}_\t\n\x0B\f\r\x1C-\x1F\x85\p{Z}]"
)


def tokenize_words(text: Column | str) -> Column:
    """Split ``text`` into word and punctuation tokens, case kept."""
    t = F.col(text) if isinstance(text, str) else text
    return F.regexp_extract_all(t, F.lit(WORD_PATTERN), 0)


# Two characters that no token holds mark the dots of abbreviations and the
# sentence ends while the rules below run.
_DOT, _END = "\x01", "\x02"
_SPACE = WHITESPACE_CLASS
_BLANK = _SPACE[1:-1]

# Abbreviations whose dot ends no sentence.
ABBREVIATIONS = ["Mr", "Mrs", "Ms", "Dr", "Prof", "St", "Jr", "Sr", "Vol", "No", "vs", "etc"]

# Words that the treebank convention writes as two.
FUSED_WORDS = [("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na")]

_CLITICS = r"([\p{L}\p{N}])('(?:s|S|m|M|d|D|ll|LL|re|RE|ve|VE))([^\p{L}\p{N}])"


def treebank_rules() -> list[tuple[str, str]]:
    """The ordered rewrite rules of :func:`tokenize_treebank` as (pattern,
    replacement with ``$n`` groups), for a text with a blank on either side."""
    rules = [
        (rf"[{_DOT}{_END}]", " "),
        # a dot behind an initial or an abbreviation stays with it
        (rf"(^|[^\p{{L}}\p{{N}}])((?:\p{{Lu}}\.)*\p{{Lu}}|{'|'.join(ABBREVIATIONS)})\.", rf"$1$2{_DOT}"),
        # a sentence ends where a capital letter or a digit follows the end mark
        (rf"([.!?][\"')\]]*){_SPACE}+([\"'(\[]*[\p{{Lu}}\p{{N}}])", rf"$1 {_END} $2"),
        # double quotes: opening ones, then all others
        (rf'([{_BLANK}(\[{{<])"', "$1 `` "),
        (r'"', " '' "),
        (r"(\.\.\.+)", " $1 "),
        (r"([;@#$%&?!\[\](){}<>])", " $1 "),
        # commas and colons inside numbers and times stay there
        (r"([,:]+)([^\p{N},:])", " $1 $2"),
        (r"(--+)", " $1 "),
        # only the last dot of a sentence is a token of its own
        (rf"([^.{_BLANK}])\.((?:{_SPACE}|[\])}}>'])*)({_END}|\z)", "$1 . $2$3"),
        # contractions; twice, as two of them may meet
        (r"(\p{L})(n't|N'T)([^\p{L}\p{N}])", "$1 $2$3"),
        (_CLITICS, "$1 $2$3"),
        (_CLITICS, "$1 $2$3"),
        (rf"([^'{_BLANK}])'({_SPACE})", "$1 ' $2"),
    ]
    for a, b in FUSED_WORDS:
        first = f"[{a[0].upper()}{a[0]}]{a[1:]}"
        rules.append((rf"([^\p{{L}}\p{{N}}])({first})({b})([^\p{{L}}\p{{N}}])", "$1$2 $3$4"))
    return rules


def _needs() -> dict[str, list[str]]:
    """Per pattern of :func:`treebank_rules` the strings of which a match must
    hold one: searching those is cheap, and few texts have any."""
    needs = {rf"[{_DOT}{_END}]": [_DOT, _END], r'"': ['"'], r"(\.\.\.+)": ["..."], r"(--+)": ["--"],
             r"(\p{L})(n't|N'T)([^\p{L}\p{N}])": ["n't", "N'T"], _CLITICS: ["'"]}
    for pattern, replacement in treebank_rules():
        if replacement == "$1 `` ":
            needs[pattern] = ['"']
        elif replacement == "$1 ' $2":
            needs[pattern] = ["'"]
        for a, b in FUSED_WORDS:
            if f"]{a[1:]})({b})" in pattern:
                needs[pattern] = [a[1:] + b]
    return needs


def _treebank_marked(text: Column | str) -> Column:
    t = F.col(text) if isinstance(text, str) else text
    t = F.concat(F.lit(" "), t, F.lit(" "))
    needs = _needs()

    def rule(x: Column, pattern: str, replacement: str) -> Column:
        done = F.regexp_replace(x, pattern, replacement)
        held = [F.contains(x, F.lit(n)) for n in needs.get(pattern, [])]
        return F.when(reduce(or_, held), done).otherwise(x) if held else done

    for pattern, replacement in treebank_rules():
        # bound as a lambda variable, the text so far is computed once
        once = partial(rule, pattern=pattern, replacement=replacement)
        t = F.get(F.transform(F.array(t), lambda x: once(x)), F.lit(0)) if pattern in needs else once(t)
    return F.replace(t, F.lit(_DOT), F.lit("."))


def _words_of(marked: Column) -> Column:
    return F.filter(F.split(marked, _SPACE + "+"), lambda w: (w != F.lit("")) & (w != F.lit(_END)))


def tokenize_treebank(text: Column | str) -> Column:
    """Split ``text`` into tokens the way the Penn Treebank writes them, case
    kept: ``don't`` is ``do`` + ``n't``, ``it's`` is ``it`` + ``'s``,
    ``cannot`` is ``can`` + ``not``, double quotes become two back or
    straight single ones, other marks stand alone, commas and colons between
    digits and hyphens stay inside, and a dot is cut off only where it ends a
    sentence. A run of commas and colons is one token; a single quote before
    a word stays on it. An empty or blank text gives an empty array, NULL
    stays NULL."""
    return _words_of(_treebank_marked(text))


def sentences_treebank(text: Column | str) -> Column:
    """The tokens of :func:`tokenize_treebank`, one array per sentence.
    Sentences end at ``.``, ``!`` or ``?`` with closing quotes or brackets,
    white space and a capital letter or digit behind; the dots of initials
    and of :data:`ABBREVIATIONS` end none."""
    parts = F.transform(F.split(_treebank_marked(text), _END), _words_of)
    return F.filter(parts, lambda s: F.size(s) > 0)

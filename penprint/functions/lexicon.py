"""Fixed values of the text rules: patterns, punctuation, word lists.

Patterns are Java regular expressions. ``FLAGS`` makes ``^`` and ``$`` work
per line, with the line feed as the only line end.
"""

FLAGS = "(?md)"

# ASCII punctuation, in code order.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Characters removed from both ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# One white space character, Unicode spaces included.
SPACE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"

# The START/END marker lines of a book file, with the optional
# "THE END" tail before the second one.
BODY_MARKER = (
    r"(?:^\s+THE END(?s:.*?)^)?\*{3} (?:START|END) OF THE PROJECT GUTENBERG .+ \*{3}$"
)

# The contents block, section headings in it (title = group 4)
# and chapter entries in it (name = group 6).
CONTENTS_BLOCK = r"(Contents|CONTENTS)([\s\S]*?)(\n{4})"
CONTENTS_SECTION = r"^\s*(PART (I[XV]|V?I{0,3})|(FIRST|SECOND) EPISODE)[.:](.*)$"
CONTENTS_CHAPTER = (
    r"^\s*(CHAPTER|Chapter)?\s*"
    r"((?=[MDCLXVI])M*(C[MD]|D?C{0,3})(X[CL]|L?X{0,3})(I[XV]|V?I{0,3})|\d{1,3})"
    r"\.? (.*?)\d{0,3}$"
)

# Normalising rules for books, applied in this order. The third
# entry holds strings one of which is part of every match, so that a text
# without them needs no search; empty = always search. A look-ahead at the
# start of a pattern only rules out places early, and the first rule is
# written so that long runs of spaces are read once.
NORMALIZE_RULES = (
    (r"^[\s\x0B\x1C-\x1F\x{85}\p{Z}*]+$", "", ()),
    (r"[“”]", '"', ("“", "”")),
    (r"[‘’]", "'", ("‘", "’")),
    (r"[_‖•]", "", ("_", "‖", "•")),
    (r"[–—]", "--", ("–", "—")),
    (r"\[(?s:.*?)\]$", "", ("[",)),
    (r"\[(?s:.*?)\]", "", ("[",)),
    (r"\|(.*)\|", "", ("|",)),
    (rf"{SPACE}+\+-+\+", "", ("+-",)),
    (rf"^{SPACE}+\.{{5,}}(?s:.*?)\.{{5,}}.*$", "", (".....",)),
    (r"\n{3,}", "\n\n", ("\n\n\n",)),
    (r'"', "", ('"',)),
    (r"--", " -- ", ("--",)),
    (r"^End of Project Gutenberg's .*$", "", ("End of Project Gutenberg's ",)),
    (r"(?=\p{Nd})(\p{Nd}{4,}|\p{Nd}{1,3}-\p{Nd}{1,3}-\p{Nd}{1,3})", "", ()),
    (r"\p{Nd}{2,}\.\p{Nd}{2}", "", (".",)),
    (r"\p{Nd}{1,}(th|st|nd|rd)", "", ("th", "st", "nd", "rd")),
    (
        rf"(?=[$£0-9]|{SPACE}[0-9])(\$|£)?{SPACE}?([0-9]{{1,3}},)?([0-9]{{1,3}},)?([0-9]{{1,3}})",
        "",
        tuple("0123456789"),
    ),
    (r"vi{2,}", "", ("vii",)),
)

# Normalising rules for texts to be scored, applied in this order.
COMPACT_RULES = (
    (r"^[\s\x0B\x1C-\x1F\x{85}\p{Z}*]+$", "", ()),
    (r"[“”]", '"', ("“", "”")),
    (r"[‘’]", "'", ("‘", "’")),
    (r"[–—]", "-", ("–", "—")),
    (r"\[(?s:.*?)\]$", "", ("[",)),
    (r"\[(?s:.*?)\]", "", ("[",)),
    (r"\|(.*)\|", "", ("|",)),
    (rf"{SPACE}+\+-+\+", "", ("+-",)),
    (rf"^{SPACE}+\.{{5,}}(?s:.*?)\.{{5,}}.*$", "", (".....",)),
    (r"\n{3,}", "\n\n", ("\n\n\n",)),
    (r'"', "", ('"',)),
    (r"--", "", ("--",)),
    (r"^End of Project Gutenberg's .*$", "", ("End of Project Gutenberg's ",)),
    (r"(?=\p{Nd})(\p{Nd}{4,}|\p{Nd}{1,3}-\p{Nd}{1,3}-\p{Nd}{1,3})", "", ()),
    (r"\p{Nd}{2,}\.\p{Nd}{2}", "", (".",)),
    (r"\p{Nd}{1,}(th|st|nd|rd)", "", ("th", "st", "nd", "rd")),
    (
        rf"(?=[$£0-9]|{SPACE}[0-9])(\$|£)?{SPACE}?([0-9]{{1,3}},)*[0-9]{{1,3}}",
        "",
        tuple("0123456789"),
    ),
    (r"vi{2,}", "", ("vii",)),
)

# Contractions that are whole words, then endings of any word: pattern,
# replacement, and strings as above.
CONTRACTED_WORDS = (
    (r"([Cc]an)'t", "$1not", ("an't",)),
    (r"([Ww])on't", "$1ill not", ("on't",)),
    (r"([Ss]ha)n't", "$1ll not", ("han't",)),
    (r"([Aa])in't", "$1re not", ("in't",)),
    (r"([Ll]et)'s", "$1 us", ("et's",)),
    (
        r"([Ii]t|[Hh]e|[Ss]he|[Tt]hat|[Tt]here|[Hh]ere|[Ww]hat|[Ww]here|[Ww]ho|[Hh]ow)'s",
        "$1 is",
        ("t's", "e's", "o's", "w's"),
    ),
    (r"([Ii])'m", "$1 am", ("'m",)),
    (
        r"([Ii]|[Yy]ou|[Hh]e|[Ss]he|[Ii]t|[Ww]e|[Tt]hey|[Tt]hat|[Tt]here|[Ww]ho)'d",
        "$1 would",
        ("'d",),
    ),
    (r"([Oo])'clock", "$1f the clock", ("'clock",)),
    (r"([Mm])a'am", "$1adam", ("a'am",)),
    (r"([Yy])'all", "$1ou all", ("'all",)),
)
CONTRACTED_ENDINGS = (
    (r"n't", " not", ("n't",)),
    (r"'re", " are", ("'re",)),
    (r"'ve", " have", ("'ve",)),
    (r"'ll", " will", ("'ll",)),
)

# Not inside a word, before and after.
WORD_START = r"(?<![\p{L}\p{N}_])"
WORD_END = r"(?![\p{L}\p{N}_])"

# Word or punctuation mark, the definition of a token.
TOKEN = r"--|\.\.\.|[\p{L}\p{N}_]+(?:[-'][\p{L}\p{N}_]+)*|[^\s\p{L}\p{N}_]"

# A feature term is a run of two or more word characters.
TERM = r"[\p{L}\p{N}_]{2,}"

# English stop words.
STOP_WORDS = tuple(
    """
    i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself
    yourselves he him his himself she she's her hers herself it it's its itself they them their
    theirs themselves what which who whom this that that'll these those am is are was were be been
    being have has had having do does did doing a an the and but if or because as until while of at
    by for with about against between into through during before after above below to from up down
    in out on off over under again further then once here there when where why how all any both
    each few more most other some such no nor not only own same so than too very s t can will just
    don don't should should've now d ll m o re ve y ain aren aren't couldn couldn't didn didn't
    doesn doesn't hadn hadn't hasn hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't
    needn needn't shan shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
    """.split()
)

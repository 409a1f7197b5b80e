import random

import pytest
from pyspark.sql import functions as F

from penprint.functions import keys
from penprint.functions import lexicon as lex
from penprint.functions import text as tx


def one(spark, value, *functions):
    df = spark.createDataFrame([(value,)], "v string")
    column = F.col("v")
    for f in functions:
        column = f(column)
    return df.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("“Stop!” cried Lupin", "Stop! cried Lupin"),
        ("l’homme", "l'homme"),
        ("word—word", "word -- word"),
        ("_very_ •", "very"),
        ("one [Illustration:\na map] two", "one  two"),
        ("a |box| b", "a  b"),
        ("left\n * * *\nright", "left\n\nright"),
        ("a\n\n\n\n\nb", "a\n\nb"),
        ("in 1905 and 12-34-56", "in  and"),
        ("at 10.30 on the 3rd", "at  on the"),
        ("paid £1,200,000 now", "paid  now"),
        ("chapter viii", "chapter"),
        ("kept\nEnd of Project Gutenberg's Book, by A", "kept"),
        ("   padded　 ", "padded"),
        ("x\n  ......\nart\n ...... z\ny", "x\n\ny"),
    ],
)
def test_normalize(spark, raw, expected):
    assert one(spark, raw, tx.normalize) == expected


def test_compact_rules_differ(spark):
    assert one(spark, "a—b -- c", tx.normalize_compact) == "a-b  c"
    assert one(spark, "_x_", tx.normalize_compact) == "_x_"
    assert one(spark, "sum 1,234,567,890 end", tx.normalize_compact) == "sum end"


@pytest.mark.parametrize(
    "raw, expected",
    [
        ("I can't, won't and shan't", "I cannot, will not and shall not"),
        ("Don't they're we've he'll", "Do not they are we have he will"),
        ("It's he's let's I'm she'd", "It is he is let us I am she would"),
        ("can't can't", "cannot cannot"),
        ("John's toucan't", "John's touca not"),
        ("élan't", "éla not"),
        ("plain text", "plain text"),
    ],
)
def test_contractions(spark, raw, expected):
    assert one(spark, raw, tx.expand_contractions) == expected


def test_guards_do_not_change_results(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for rules in (lex.NORMALIZE_RULES, lex.COMPACT_RULES):
        bare = [(p, r, ()) for p, r, _ in rules]
        same = docs.select(
            (tx.normalize(F.col("text"), rules) == tx.normalize(F.col("text"), bare)).alias("s")
        )
        assert same.where(~F.col("s")).count() == 0


def test_blank_line_rule_equals_its_longer_form(spark):
    longer = rf"^{lex.SPACE}*[\s\x0B\x1C-\x1F\x{{85}}\p{{Z}}*]+$"
    rng = random.Random(1)
    texts = ["".join(rng.choice(" \n\t*ax") for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    short, replacement, needed = lex.NORMALIZE_RULES[0]
    a = df.select(tx.apply_rules(F.col("v"), [(short, replacement, needed)])).collect()
    assert a == df.select(tx.apply_rules(F.col("v"), [(longer, "", ())])).collect()


def test_every_needed_string_list_covers_its_pattern(spark):
    samples = [
        "“a” ‘b’ _c_ –d— [e]\n|f| +--+ x\n  .....\n .....\n\n\n\n \"q\" -- 1905 10.30 3rd 21st 2nd 5th $5 viii",
        "can't won't shan't ain't let's it's I'm I'd o'clock ma'am y'all don't we're we've we'll",
    ]
    rows = spark.createDataFrame([(s,) for s in samples], "v string")
    for rules in (lex.NORMALIZE_RULES, lex.CONTRACTED_WORDS, lex.CONTRACTED_ENDINGS):
        for pattern, replacement, needed in rules:
            rule, bare = (pattern, replacement, needed), (pattern, replacement, ())
            a = rows.select(tx.apply_rules(F.col("v"), [rule])).collect()
            assert a == rows.select(tx.apply_rules(F.col("v"), [bare])).collect(), pattern


def test_tokens_punctuation_and_stop_words(spark):
    text = "The cat -- and the dog... said: well-known don't"
    assert one(spark, text, tx.raw_tokens) == [
        "The", "cat", "--", "and", "the", "dog", "...", "said", ":", "well-known", "don't",
    ]
    # a dash pair and an ellipsis are not pieces of the punctuation string
    assert one(spark, text, lambda c: tx.word_tokens(c, keep_punctuation=False)) == [
        "the", "cat", "--", "and", "the", "dog", "...", "said", "well-known", "don't",
    ]
    # stop words are compared in their own case
    kept = one(spark, text, lambda c: tx.word_tokens(c, remove_stopwords=True))
    assert kept[:2] == ["the", "cat"] and "and" not in kept and "don't" not in kept
    folded = one(
        spark, text, lambda c: tx.word_tokens(c, remove_stopwords=True, fold_case=True)
    )
    assert "the" not in folded


def test_terms_and_ngrams(spark):
    assert one(spark, "A Été_1 x ab", tx.terms) == ["été_1", "ab"]
    df = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],)], "w array<string>")
    got = [r[0] for r in df.select(tx.ngrams(F.col("w"), 1, 3)).collect()]
    assert got == [["a", "b", "c", "a b", "b c", "a b c"], ["a"], []]
    only = [r[0] for r in df.select(tx.ngrams(F.col("w"), 2, 2)).collect()]
    assert only == [["a b", "b c"], [], []]


def test_term_frequencies(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],)], "w array<string>")
    rows = [r[0] for r in df.select(tx.term_frequencies(F.col("w"))).collect()]
    assert [tuple(x) for x in rows[0]] == [("a", 1), ("b", 2)]
    assert rows[1] is None


def test_word_count_and_hyphen(spark):
    assert one(spark, "a  b \n c", tx.naive_word_count) == 3
    assert one(spark, "word- next x-y", tx.fix_hyphen_tail) == "word next x-y"


def test_names_and_paths(spark):
    assert one(spark, "G.K. Chesterton", keys.author_slug) == "gk_chesterton"
    title = "The Man Who Was Thursday: A Nightmare, Part"
    assert one(spark, title, keys.title_slug) == "the_man_who_was_thursday__a_nightmare_part"
    path = r"data\agatha_christie\poirot\data.csv"
    assert one(spark, path, lambda c: keys.path_part(c, 3)) == "agatha_christie"
    assert one(spark, path, lambda c: keys.path_part(c, 9)) is None
    assert one(spark, "PG123", keys.code_from_id) == 123


def test_unknown_author_is_an_error(spark):
    with pytest.raises(Exception, match="author without a class"):
        one(spark, "x", lambda c: keys.class_label(c, {"a": 0}))
    assert one(spark, "a", lambda c: keys.class_label(c, {"a": 0})) == 0

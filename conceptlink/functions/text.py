"""Text and keyword-list expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from conceptlink.functions.vec import let

# A token is a run of letters, a run of digits, or one other mark.
TOKEN_PATTERN = r"\p{L}+|[0-9]+|[^\s\p{L}0-9]"

# ASCII punctuation in code-point order.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Emoji code-point ranges.
EMOJI_CLASS = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}]"

# The English stop words of Spark ML's StopWordsRemover.
STOPWORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs
themselves what which who whom this that these those am is are was were be
been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through
during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few
more most other some such no nor not only own same so than too very s t can
will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd
she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't
won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
how's let's ought that's there's what's when's where's who's why's would
""".split()


def tokens(text: Column, lowercase: bool = False) -> Column:
    """Letter runs, digit runs and single marks, in text order."""
    found = F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))
    return F.transform(found, F.lower) if lowercase else found


def without_stopwords(words: Column, case_insensitive: bool = False) -> Column:
    """Drop stop words; by default only exact lowercase matches ("The" stays)."""
    shape = F.lower if case_insensitive else (lambda w: w)
    return F.filter(words, lambda w: ~shape(w).isin(STOPWORDS))


def without_punctuation(words: Column) -> Column:
    """Drop words that are a substring of the ASCII punctuation list."""
    return F.filter(words, lambda w: F.instr(F.lit(PUNCTUATION), w) == 0)


def clean_tokens(text: Column, lowercase: bool = False, remove_stopwords: bool = True) -> Column:
    """Tokens without stop words and punctuation."""
    words = tokens(text, lowercase)
    if remove_stopwords:
        words = without_stopwords(words)
    return without_punctuation(words)


def counted(words: Column) -> Column:
    """Distinct words of a list with their number, as ``array<struct<token, n>>``; counted within the row. Nulls are no words."""

    def runs(ordered: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.size(ordered)),
            lambda i: (i == 1) | (F.get(ordered, i - 1) != F.get(ordered, i - 2)),
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda s, k: F.struct(
                    F.get(ordered, s - 1).alias("token"),
                    (F.coalesce(F.get(at, k + 1), F.size(ordered) + 1) - s).alias("n"),
                ),
            ),
        )

    none = F.array().cast("array<struct<token:string,n:int>>")
    words = F.array_compact(words)
    return F.when(F.size(words) > 0, let(F.array_sort(words), runs)).otherwise(none)


def corpus_tokens(text: Column) -> Column:
    """Corpus tokens: ``, ! ; -`` runs become a full stop, the rest is lowercased,
    and only letter words, full stops and emoji stay."""
    marked = F.regexp_replace(text, "[,!;-]+", ".")
    words = F.transform(tokens(marked), F.lower)
    return F.filter(
        words,
        lambda w: w.rlike(r"^\p{L}+$") | (w == ".") | w.rlike(EMOJI_CLASS),
    )


def parse_list(literal: Column) -> Column:
    """List literal in a string column to an array; anything else gives null."""
    return F.from_json(
        literal,
        "array<string>",
        {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"},
    )


def list_literal(words: Column) -> Column:
    """Array to the list-literal form the keyword column carries."""
    return F.concat(F.lit("['"), F.concat_ws("', '", words), F.lit("']"))


def capitalized(word: Column) -> Column:
    """First letter upper case, the rest lower case."""
    # a first letter may have a longer capital form, of which only the first letter is upper case
    first = F.upper(F.substring(word, 1, 1))
    rest = F.concat(F.substring(first, 2, 9), F.substring(word, 2, 2**31 - 1))
    return F.concat(F.substring(first, 1, 1), F.lower(rest))


@F.pandas_udf(StringType())
def _ascii_letters(words: pd.Series) -> pd.Series:
    def fold(word: str) -> str:
        decomposed = unicodedata.normalize("NFKD", word)
        return "".join(c for c in decomposed if c.isascii() and c.isalpha()).lower()

    return words.map(fold, na_action="ignore")


def strip_accents(df: DataFrame, column: str, out: str) -> DataFrame:
    """Decompose, keep ASCII letters, lowercase; each distinct value is folded once. A null stays null."""
    folded = df.select(column).distinct().withColumn(out, _ascii_letters(column))
    return df.join(folded, column, "left")

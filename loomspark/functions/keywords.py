"""Keyword and phrase match on lower-cased whole words.

A lemma model is not available offline: a keyword meets its exact word forms, or those
that :func:`inflections` makes by rule.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.session import ensure_importable

WORD = "[a-zà-öø-ÿß]+"
#: Words up to which a list is part of the plan, and phrases up to which an automaton travels to the tasks.
WORD_LIMIT, PHRASE_LIMIT = 10_000, 200_000


def keyword_hits(docs: DataFrame, keywords: DataFrame, id_col: str, text_col: str, limit: int = WORD_LIMIT) -> DataFrame:
    """``(id, word, n)``: how often each keyword stands in each document.

    A list of up to ``limit`` words filters a document's words before they become rows; a
    longer one is joined with them.
    """
    wanted = keywords.select(F.lower("word").alias("word")).where("word IS NOT NULL").distinct()
    words = F.regexp_extract_all(F.lower(text_col), F.lit(WORD), F.lit(0))
    known = [r.word for r in wanted.limit(limit + 1).collect()]
    if len(known) <= limit:
        rows = docs.select(id_col, F.explode(F.filter(words, lambda w: w.isin(known) if known else F.lit(False))).alias("word"))
    else:
        rows = docs.select(id_col, F.explode(words).alias("word")).join(wanted, "word", "left_semi")
    return rows.groupBy(id_col, "word").agg(F.count(F.lit(1)).alias("n"))


def inflections(word: str) -> set[str]:
    """The word and its regular English forms: plural or third person, past, participle, comparison."""
    forms = {word, word + "s", word + "ed", word + "ing"}
    if word.endswith(("s", "x", "z", "ch", "sh", "o")):
        forms |= {word + "es"}
    if word.endswith("e"):
        forms |= {word + "d", word + "r", word + "rs", word[:-1] + "ing"}
    elif len(word) > 2 and word[-1] == "y" and word[-2] not in "aeiou":
        forms |= {word[:-1] + "ies", word[:-1] + "ied", word[:-1] + "ier"}
    else:
        forms |= {word + "er", word + "ers"}
    if len(word) > 2 and word[-1] not in "aeiouwxy" and word[-2] in "aeiou" and word[-3] not in "aeiou":
        forms |= {word + word[-1] + end for end in ("ed", "ing", "er", "ers")}
    return forms


class PhraseAutomaton:
    """Aho-Corasick over words: all phrases that end at each word, in one pass.

    Of an inflected phrase the last word varies.  A form that two phrases share counts for both.
    """

    def __init__(self, phrases: Iterable[str], inflected: bool = False):
        self.next: list[dict[str, int]] = [{}]
        self.ends: list[list[str]] = [[]]
        for phrase in sorted(set(phrases)):
            words = phrase.split()
            if not words:
                continue
            for last in inflections(words[-1]) if inflected else {words[-1]}:
                at = 0
                for word in (*words[:-1], last):
                    if word not in self.next[at]:
                        self.next[at][word] = len(self.next)
                        self.next.append({})
                        self.ends.append([])
                    at = self.next[at][word]
                self.ends[at].append(phrase)
        self.back = [0] * len(self.next)
        queue = list(self.next[0].values())
        for at in queue:
            for word, to in self.next[at].items():
                back = self.back[at]
                while back and word not in self.next[back]:
                    back = self.back[back]
                self.back[to] = self.next[back].get(word, 0)
                self.ends[to] = self.ends[to] + self.ends[self.back[to]]
                queue.append(to)

    def counts(self, words: Iterable[str]) -> dict[str, int]:
        found: dict[str, int] = {}
        at = 0
        for word in words:
            while at and word not in self.next[at]:
                at = self.back[at]
            at = self.next[at].get(word, 0)
            for phrase in self.ends[at]:
                found[phrase] = found.get(phrase, 0) + 1
        return found


def phrase_hits(docs: DataFrame, phrases: DataFrame, id_col: str, text_col: str, inflected: bool = False, limit: int = PHRASE_LIMIT) -> DataFrame:
    """``(id, phrase, n)``: how often each phrase's words stand in a row in each document, overlaps included.

    ``phrases`` has a ``phrase`` column; case and the space between words do not count, and what
    is no word there is a space.  Up to ``limit`` phrases are one automaton, which every task
    reads its texts by; more meet the texts' word sequences in a join, by their words.
    """
    spark = docs.sparkSession
    words_of = lambda c: F.regexp_extract_all(F.lower(c), F.lit(WORD), F.lit(0))
    wanted = phrases.select(F.array_join(words_of("phrase"), " ").alias("phrase")).where("phrase <> ''").distinct()
    words = docs.select(id_col, words_of(text_col).alias("words"))
    known = [r.phrase for r in wanted.limit(limit + 1).collect()]
    kind = docs.schema[id_col].dataType.simpleString()
    if len(known) <= limit:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema
        from pyspark.sql.types import StructType

        ensure_importable(spark)
        ddl = f"`{id_col}` {kind}, phrase string, n bigint"
        schema = to_arrow_schema(StructType.fromDDL(ddl))

        def run(batches) -> Iterator[pa.RecordBatch]:
            automaton = PhraseAutomaton(known, inflected)
            for batch in batches:
                rows = [(i, p, n) for i, w in zip(*(c.to_pylist() for c in batch.columns), strict=True) for p, n in automaton.counts(w or ()).items()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

        # rows of one id are one document
        return words.mapInArrow(run, ddl).groupBy(id_col, "phrase").agg(F.sum("n").alias("n"))
    if inflected:
        forms = F.udf(lambda p: [" ".join([*p.split()[:-1], x]) for x in inflections(p.split()[-1])], "array<string>")
        wanted = wanted.select("phrase", F.explode(forms("phrase")).alias("form"))
    else:
        wanted = wanted.withColumn("form", F.col("phrase"))
    sizes = [r[0] for r in wanted.select(F.size(F.split("form", " "))).distinct().collect()]  # as many as lengths of phrases

    def sequences(n: int):
        starts = F.when(F.size("words") >= n, F.sequence(F.lit(1), F.size("words") - (n - 1))).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.array_join(F.slice("words", i, n), " "))

    every = F.flatten(F.array(*map(sequences, sizes))) if sizes else F.array().cast("array<string>")
    runs = words.select(id_col, F.explode(every).alias("form"))
    return runs.join(wanted, "form").groupBy(id_col, "phrase").agg(F.count(F.lit(1)).alias("n"))


def read_keywords(spark, path: str) -> DataFrame:
    """A JSON-lines list with a ``word`` in each line."""
    return spark.read.schema("word string").json(path)

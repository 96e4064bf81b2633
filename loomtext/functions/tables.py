"""Table functions for SQL: the lines and the tokens of a text."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from ..tokenize import segment


@udtf(returnType="n int, line string")
class TextLines:
    """Lines of a text that are not empty, numbered from 0 as they stand in it. A null text has none."""

    def eval(self, text: str) -> Iterator[tuple[int, str]]:
        for n, line in enumerate((text or "").split("\n")):
            if line:
                yield n, line


@udtf(returnType="n int, token string")
class TextTokens:
    """Tokens of a text by the segmenter of a language, numbered from 0. A null text has none."""

    def eval(self, lang: str, text: str) -> Iterator[tuple[int, str]]:
        yield from enumerate(segment(lang, text or ""))


def register(spark: SparkSession) -> None:
    """text_lines(text) and text_tokens(lang, text) for SQL, to be joined laterally."""
    spark.udtf.register("text_lines", TextLines)
    spark.udtf.register("text_tokens", TextTokens)

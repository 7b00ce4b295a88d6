"""Native scorers: word counts as column expressions.

They stand in for a hosted model, with the same answer columns, wherever a reproducible score is
wanted; they say nothing about a text's real tone. All word lists are parameters.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from freshet.functions.columns import once
from freshet.functions.models import USER_NEEDS


def tokens(text: Column) -> Column:
    """Maximal runs of a-z in the lower-cased text; none for a null text."""
    return F.split(F.lower(F.coalesce(text, F.lit(""))), "[^a-z]+")


def _hits(words: Column, listed: tuple[str, ...]) -> Column:
    return F.size(F.filter(words, lambda t: t.isin(*listed)))


def counted(text: Column, lists: dict[str, tuple[str, ...]], body: Callable[[Column], Column]) -> Column:
    """`body` of a struct with the number of tokens, `n`, and of those in each of the lists."""
    listed = sorted({word for words in lists.values() for word in words})

    def sizes(words: Column) -> Column:
        # Splitting leaves an empty string where the text starts or ends with another character.
        size = F.size(words)
        first, last = F.element_at(words, 1) == "", F.element_at(words, -1) == ""
        n = size - first.cast("int") - (last & (size > 1)).cast("int")
        hits = F.filter(words, lambda t: t.isin(*listed))

        def per_list(found: Column) -> Column:
            return F.struct(
                n.alias("n"),
                *[_hits(found, words).alias(name) for name, words in lists.items()],
            )

        return once(hits, per_list)

    return once(once(tokens(text), sizes), body)


def _share(part: Column, whole: Column) -> Column:
    return F.round(part / F.greatest(whole, F.lit(1)), 6)


@dataclass(frozen=True)
class SentimentLexicon:
    positive: tuple[str, ...]
    negative: tuple[str, ...]

    def __call__(self, text: Column) -> Column:
        def answer(count: Column) -> Column:
            up, down = count.getField("up"), count.getField("down")
            score = _share(up - down, up + down)
            label = F.when(score > 0.1, "positive").when(score < -0.1, "negative").otherwise("neutral")
            confidence = _share(up + down, count.getField("n"))
            return F.struct(score.alias("score"), label.alias("sentiment"), confidence.alias("confidence"))

        return counted(text, {"up": self.positive, "down": self.negative}, answer)


@dataclass(frozen=True)
class NeedsLexicon:
    """Per need category the word lists of its two types, in the model's order."""

    words: dict[str, tuple[tuple[str, ...], tuple[str, ...]]]

    def __call__(self, text: Column) -> Column:
        lists = {f"{name}_{i}": words for name, pair in self.words.items() for i, words in enumerate(pair)}

        def answer(count: Column) -> Column:
            needs, types = [], []
            for need in USER_NEEDS.fields:
                if not need.fields:
                    continue
                first, second = count.getField(f"{need.name}_0"), count.getField(f"{need.name}_1")
                allowed = need.fields[0].allowed
                types.append(F.when(first >= second, allowed[0]).otherwise(allowed[1]))
                needs.append(
                    F.struct(
                        types[-1].alias("type"),
                        _share(F.greatest(first, second), first + second).alias("score"),
                        _share(first + second, count.getField("n")).alias("confidence"),
                    ).alias(need.name)
                )
            return F.struct(*needs, F.concat_ws("; ", *types).alias("summary"))

        return counted(text, lists, answer)

"""Lexicon sentiment with the published rules for emphasis, degree, negation and contrast.

A word counts its valence.  Capitals in a text that isn't all capitals add to it; degree words before it add
or take, the less the further away (up to three words); a negation among these words turns it.  After the first "but"
everything weighs more, before it less.  Exclamation and question marks push the sum outwards, which is then
brought within -1 and 1.

The lexicon, the degree words and the negations are inputs.  Texts are scored in Arrow batches, a word by one
look-up, so a lexicon of any size costs the same.

Defined results: null texts score null, empty and blank ones and those without words of the lexicon 0; texts of
any length are read whole; repeated rows score alike.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published rules.
CAPITALS = 0.733
DISTANCE = (1.0, 0.95, 0.9)
NEGATED = -0.74
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION, EXCLAMATIONS = 0.292, 4
QUESTION, QUESTIONS = 0.18, 0.96
ALPHA = 15.0
DEGREE = 0.293

BOOSTERS = {w: DEGREE for w in ("very", "really", "so", "extremely", "absolutely", "totally", "deeply", "highly", "especially", "strongly", "loudly")} | {
    w: -DEGREE for w in ("barely", "hardly", "slightly", "somewhat", "rarely", "nearly", "partly", "almost")
}
NEGATIONS = ("not", "no", "never", "none", "nobody", "nothing", "neither", "nor", "nowhere", "cannot", "without", "refused")

_SPACE = re.compile("[ \t\n\r\f\v]+")
_MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
_CAPITALS = re.compile("[^a-z]*[A-Z][^a-z]*")


class Scorer:
    def __init__(self, lexicon: dict[str, float], boosters: dict[str, float] | None = None, negations: tuple[str, ...] | None = None):
        self.boosters = BOOSTERS if boosters is None else boosters
        self.negations = frozenset(NEGATIONS if negations is None else negations)
        # A degree word has no valence of its own.
        self.lexicon = {w: v for w, v in lexicon.items() if w not in self.boosters}

    def score(self, text: str) -> float:
        words = [w for w in _SPACE.split(text) if w]
        words = [bare if len(bare := w.strip(_MARKS)) > 2 else w for w in words]
        low = [w.lower() for w in words]
        capitals = [bool(_CAPITALS.fullmatch(w)) for w in words]
        mixed = 0 < sum(capitals) < len(words)
        contrast = low.index("but") if "but" in low else None
        total = 0.0
        for i, word in enumerate(low):
            valence = self.lexicon.get(word)
            if valence is None:
                continue
            if mixed and capitals[i]:
                valence += CAPITALS if valence > 0 else -CAPITALS
            for j, weight in zip(range(i - 1, max(i - 4, -1), -1), DISTANCE):
                if low[j] in self.lexicon:
                    continue
                degree = self.boosters.get(low[j], 0.0)
                if degree:
                    side = 1.0 if valence > 0 else -1.0
                    valence += side * (degree + (CAPITALS if mixed and capitals[j] else 0.0)) * weight
                if low[j] in self.negations or low[j].endswith("n't"):
                    valence *= NEGATED
            if contrast is not None and i != contrast:
                valence *= BEFORE_BUT if i < contrast else AFTER_BUT
            total += valence
        questions = text.count("?")
        push = min(text.count("!"), EXCLAMATIONS) * EXCLAMATION + (0.0 if questions < 2 else questions * QUESTION if questions < 4 else QUESTIONS)
        total += push if total > 0 else -push if total < 0 else 0.0
        return round(total / (total * total + ALPHA) ** 0.5, 4) if total else 0.0


def sentiment(text: Column, lexicon: dict[str, float], boosters: dict[str, float] | None = None, negations: tuple[str, ...] | None = None) -> Column:
    """The compound score of ``text``, within -1 and 1, to 4 decimals."""
    scorer = Scorer(lexicon, boosters, negations)

    @F.pandas_udf("double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([None if t is None else scorer.score(t) for t in texts], dtype="float64")

    return run(text)

"""Places in free text: a city followed by a state, by its code or its full name."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def city_state(text: Column, states: dict[str, str]) -> Column:
    """(city, state code) of the first ``City, ST`` or ``City, State`` whose state is in ``states`` ({code: name});
    both null where there is none.

    A city is one to four capitalised words.  Codes count in capitals only, names in any case; the longest name that
    fits is taken.
    """
    names = sorted(states.values(), key=lambda n: (-len(n), n))
    either = "|".join([*map(re.escape, sorted(states)), *(f"(?i:{re.escape(n)})" for n in names)])
    word = r"[A-Z][\p{L}.'’-]*"
    pattern = rf"({word}(?: {word}){{0,3}}), *({either})(?![\p{{L}}\p{{N}}])"
    found = F.regexp_extract(text, pattern, 2)
    code = F.create_map(*[F.lit(x) for c, n in states.items() for x in (n.lower(), c)])
    state = F.when(found.isin(list(states)), found).otherwise(code[F.lower(found)])
    return F.struct(F.when(state.isNotNull(), F.regexp_extract(text, pattern, 1)).alias("city"), state.alias("state"))

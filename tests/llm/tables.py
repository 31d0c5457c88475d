"""Small tables for the tests of shelfseek.llm."""

from __future__ import annotations

import random

WORDS = "the of and to in that is was he for it with as his on be at by had not are but from or have an they which one you were her all she there would their we him been has when who will more no if out so said what up its about into than them can only other new some could time these two may then do first any my now such like our over man me even most made after also did many before must through back years where much your way well down should because each just those people mr how too little state good very make world still own see men work long get here between both life being under never day same another know while last might us great old year off come since against go came right used take three".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def odd_texts() -> list[str | None]:
    return [None, "", " ", "\n\t ", "one", "Two words", "a b c d", "a b c d e", "É é É ñ 中文 字", "x" * 3000, "same\nsame\n\nsame"]


def collect(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)

"""Rows that every operator must take: nulls, empty and long texts, ties, repeats, clashing names."""

import random
import re

ODD = [
    (1, ""), (2, None), (3, "   \n\t "), (4, "word"), (5, "One two three"), (5, "One two three"), (None, "no id here"),
    (7, "x" * 30_000), (8, "the same words again and again " * 2_000), (9, "the same words again and again " * 2_000),
    (10, "Ünïcode é ﬁ 日本語 　 \x1c 👍🏽 İ ΣΑΣ"), (11, "<|endoftext|> a<|startoftext|>B <|ENDOFTEXT|>"), (12, "\x00 a\x00b"), (13, "%%% $$$ ### |"),
]
SCHEMA = "doc_id long, text string"


def words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def prose(seed, n, vocabulary=400):
    rng = random.Random(seed)
    bag = ["".join(rng.choice("abcdefghijklmnoprstuvwy") for _ in range(rng.randint(2, 9))) for _ in range(vocabulary)]
    return " ".join(rng.choice(bag) for _ in range(n))

"""Small corpora with the awkward cases that every operator must take."""

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def corpus(n=60, seed=1):
    """Texts with shared passages, copies, edits, nulls, blanks, repeats and a long one."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeéßñ", k=rng.randint(1, 6))) for _ in range(400)]
    text = lambda k: " ".join(rng.choices(vocabulary, k=k))
    passage, base = text(70), text(200)
    out = [(0, None), (1, ""), (2, " \n\t "), (3, "One"), (4, "one"), (5, "x " * 300), (6, text(3000))]
    for i in range(7, n):
        kind = i % 6
        if kind == 0:
            body = text(rng.randint(20, 90)) + "\n" + passage + " " + text(rng.randint(0, 60))
        elif kind == 1:
            body = base
        elif kind == 2:
            own = base.split(" ")
            own[rng.randrange(200)] = "edited"
            body = " ".join(own)
        elif kind == 3:
            body = "\n".join([text(8)] * 5)
        else:
            body = text(rng.randint(1, 150))
        out.append((i, body))
    out.append((3, "One"))  # a repeated row
    out.append((9, text(60)))  # an id with another text
    out.append((None, base))  # no id
    return out

"""Small documents that hold what operators stumble over, and plain versions of word rules."""

import re

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, part int, seq int, n int, length int, class string, score double, rank int, stays string, _key string, _id string, _none string, _D string, _t string, _doc string, _gone string, _text_key string"


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def tricky_texts():
    prose = " ".join(f"word{i} of the {i % 7} kind," for i in range(60))
    return [
        (1, prose),
        (2, prose),  # a copy
        (3, prose.replace("word30", "other")),  # nearly a copy
        (4, ""),
        (5, None),
        (6, " \n\t\n "),
        (7, "one"),
        (8, "one two"),
        (9, "¿Qué? 日本語 <|endoftext|> a\x01b ~ x  y \n\n z"),
        (10, " ".join(f"long{i % 997}" for i in range(9000))),
        (11, "short.\n" + prose + "\nshort."),
        (11, "short.\n" + prose + "\nshort."),  # the same row again
        (None, "no id here at all"),
        (None, prose),
        (12, "ONE two"),
        (13, "!!! ... 123"),
    ]


def tricky_docs(spark, texts=None):
    rows = [(d, t, "en", "src0", len(t or ""), 1, 2, 3, 4, "c", 0.5, 1, *"abcdefghi") for d, t in (tricky_texts() if texts is None else texts)]
    return spark.createDataFrame(rows, SCHEMA)


def shingle_sets(texts, size):
    out = []
    for t in texts:
        w = words(t)
        out.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    return out


def linked_groups(sets, part, whole):
    """The group of each set (its first member), by comparing all pairs."""
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if shared and whole * shared >= part * (len(sets[i]) + len(sets[j]) - shared):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(sets))]

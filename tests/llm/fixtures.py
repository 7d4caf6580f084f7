"""Documents with what operators must stand: nulls, empty and long texts, repeats, clashing columns."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp bigint, spans array<bigint>, size bigint, kept string, component_id bigint, row string"


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6))) for _ in range(n))


def texts():
    rng = random.Random(5)
    passage = words(rng, 60)
    base = words(rng, 300)
    edited = base.split(" ")
    edited[150] = "changed"
    lines = [words(rng, 12) for _ in range(12)]
    return [
        None,
        "",
        " \n\t ",
        "one",
        "Two words",
        base,
        base,
        base.upper(),
        " ".join(edited),
        f"{words(rng, 40)} {passage} {words(rng, 50)}",
        f"{passage} {words(rng, 20)}",
        "\n".join(lines),
        "\n".join([words(rng, 12), *lines, words(rng, 9)]),
        "na " * 3000,
        words(rng, 20000),
        "é漢 ß² don't  two  spaces <|endoftext|>\r\n tab\t's end ",
        f"{words(rng, 60)}\n{'#@! ' * 50}",
        "x" * 50000,
    ]


def rows():
    sources = ["b", "a", None, "b", "b", "ä", "b", "b"]
    out = []
    for k, t in enumerate(texts()):
        out.append((k, t, "en", sources[k % len(sources)], None if t is None else len(t), 1, [1], 2, "x", 3, "r"))
    out.append(out[5])  # a repeated row
    out.append((None, "a row without an id has a text of its own here", None, None, None, None, None, None, None, None, None))
    return out


def documents(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)

"""Frames with every awkward case, for all operators."""

from __future__ import annotations

import random
import re
import zlib

CLASHES = "id bigint, n bigint, kept boolean, component_id bigint, row bigint, p double, rate double, slot bigint, shard string, word string, c bigint, grp string, center string"
CLASHES += ", gone_id bigint, _gone_id bigint, rejected_id bigint, mixed_id bigint, mixed_copies bigint, mixed_copy bigint"
CLASHES += ", base_failed boolean, distance double, g_lang string, cluster bigint, parts bigint, block int, sig string, tree int, membership string, copies bigint"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASHES}"
WORDS = "river stone cloud ember field hollow lantern meadow north orchard pebble quiet ridge silver thicket under valley willow".split()
FILL = (7, 7, False, 7, 7, 0.5, 0.5, 7, "x", "x", 7, "x", "x", *[7] * 6, True, 0.5, "x", 7, 7, 7, "x", 7, "x", 7)


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    words = [r.choice(WORDS) + r.choice(["", "", "ly", "er", "ing"]) for _ in range(n)]
    words = [w.capitalize() + "." if r.random() < 0.1 else w for w in words]
    return "\n".join(" ".join(words[i : i + 40]) for i in range(0, n, 40))


def row(doc_id, text, lang="en", source="a"):  # noqa: ANN001, ANN201
    return (doc_id, text, lang, source, len(text or ""), *FILL)


def documents(spark):  # noqa: ANN001, ANN201
    long = prose(1, 30_000)
    rows = [row(i, prose(100 + i, 60 + i)) for i in range(10, 40)]
    rows += [
        row(1, long),
        row(2, long),  # a copy
        row(2, long),  # a repeated row
        row(3, None),
        row(4, ""),
        row(5, " \t\n\r\x0b\x0c "),
        row(None, prose(3, 80)),
        row(6, "one"),
        row(7, "ONE"),
        row(8, prose(5, 100), None, None),
        row(9, "x" * 50_000),
        row(50, prose(110, 70) + " <|endoftext|> çà 漢字    end"),
        row(51, prose(110, 70) + " <|endoftext|> çà 漢字    END"),
        row(52, "**** $$$$ ||||\n**** $$$$ ||||\n" * 40),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark):  # noqa: ANN001, ANN201
    return spark.createDataFrame([], SCHEMA)


def words(text):  # noqa: ANN001, ANN201
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):  # noqa: ANN001, ANN201
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def is_held_out(doc_id) -> bool:  # noqa: ANN001
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 1


def smallest_reachable(nodes, links):  # noqa: ANN001, ANN201
    root = {n: n for n in nodes}

    def find(x):  # noqa: ANN001, ANN202
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}

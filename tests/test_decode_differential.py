"""Differential test of the strict decoder against Python's ``json`` made strict the same way: one JSON value, no
duplicate keys, no NaN/Infinity; an array of rows or one row; a row is an object or an array of its values; every row has the four fields as JSON
strings (unknown fields ignored) and ``level`` is one code point."""

import json
import random

from tracelake.operators.payload import decode_verdicts

FIELDS = ("timestamp", "level", "component", "message")


def _reject_constant(name):
    raise ValueError(name)


def _no_duplicates(pairs):
    keys = [k for k, _ in pairs]
    if len(keys) != len(set(keys)):
        raise ValueError("duplicate key")
    return dict(pairs)


def expected_rows(text):
    try:
        value = json.loads(text, object_pairs_hook=_no_duplicates, parse_constant=_reject_constant)
    except (ValueError, RecursionError):
        return None
    rows = value if isinstance(value, list) else [value]
    if isinstance(value, list) and not all(isinstance(r, dict) or isinstance(r, list) and len(r) == len(FIELDS) for r in rows):
        rows = [value]
    out = []
    for r in rows:
        if isinstance(r, list) and len(r) == len(FIELDS):  # a row by position
            r = dict(zip(FIELDS, r, strict=True))
        if not isinstance(r, dict) or any(not isinstance(r.get(f), str) for f in FIELDS) or len(r["level"]) != 1:
            return None
        out.append(tuple(r[f] for f in FIELDS))
    return out


def _row(rng):
    return {
        "timestamp": rng.choice(["2024-05-20 10:15:30.123", "t", "", "9999-99-99 00:00:00.0"]),
        "level": rng.choice(["i", "w", "e", "\U0001F600", "é"]),
        "component": rng.choice(["Comp", "A(b)", "x y", "\"q\"", "\\"]),
        "message": rng.choice(["msg", "", "a \"b\" c", "line\nbreak", "tab\t", " ", "{\"k\": 69}", "]} zz"]),
    }


def _obj_text(rng, row):
    items = [(k, json.dumps(v, ensure_ascii=rng.random() < 0.5)) for k, v in row.items()]
    m = rng.random()
    if m < 0.06:
        items.pop(rng.randrange(len(items)))                      # missing field
    elif m < 0.10:
        i = rng.randrange(len(items)); items[i] = (items[i][0], "null")
    elif m < 0.14:
        i = rng.randrange(len(items)); items[i] = (items[i][0], rng.choice(["5", "true", "[\"a\"]", "{}"]))
    elif m < 0.17:
        items.append(("level", json.dumps("w")))                   # duplicate known key
    elif m < 0.20:
        i = rng.randrange(len(items)); items[i] = (items[i][0].upper(), items[i][1])
    elif m < 0.24:
        items.append(("x", rng.choice(["{\"y\": [1]}", "1.5e3", "null", "\"\"", "[]"])))  # unknown field: fine
    elif m < 0.26:
        items.append(("n", rng.choice(["NaN", "Infinity", "01", "+1", "'s'", ".5"])))     # invalid JSON numbers/strings
    elif m < 0.28:
        i = rng.randrange(len(items)); items[i] = (items[i][0], json.dumps(rng.choice(["ii", ""])))  # bad level len
    sep = rng.choice([",", ", ", " ,\n"])
    body = sep.join(f"{json.dumps(k)}{rng.choice([':', ': ', ' : '])}{v}" for k, v in items)
    if rng.random() < 0.03:
        body = body.replace('"', "'", 2)                           # single-quoted key
    if rng.random() < 0.03:
        body += ","                                                # trailing comma
    return "{" + body + "}"


def _payload(rng):
    rows = [_row(rng) for _ in range(rng.randint(0, 3))]
    if rows and rng.random() < 0.4:
        text = _obj_text(rng, rows[0])
    else:
        text = "[" + rng.choice([",", ", "]).join(_obj_text(rng, r) for r in rows) + "]"
    m = rng.random()
    if m < 0.04:
        text += rng.choice([" zz", "] zz", "} zz", ",{}", " /* c */", "\n"])
    elif m < 0.10:  # early-close suffixes aimed at the wrapper checks
        text += rng.choice(["]", "] zz", "}", "} zz", ',"q":1', ',"q":1} zz', "]]", "},{", ',"q":1]', "]}"])
    elif m < 0.13:  # raw control characters inside a string (strict JSON forbids them)
        i = text.find('"', text.find(":"))
        if i > 0:
            text = text[: i + 1] + rng.choice(["\u0001", "\t", "\u001f"]) + text[i + 1 :]
    elif m < 0.15:
        text = rng.choice(["xx", "", "5", "null", "[\"t\",\"i\",\"c\",\"m\"]", " ", "[[]]", "// c\n[]"])
    elif m < 0.17:
        text = rng.choice(["  ", "\n", "\t"]) + text
    return text


def test_decoder_matches_strict_reference(spark):
    rng = random.Random(7)
    payloads = [_payload(rng) for _ in range(3000)]
    df = spark.createDataFrame([(i, bytearray(p.encode())) for i, p in enumerate(payloads)], "offset long, value binary")
    got = {}
    for r in decode_verdicts(df, lineage=["offset"]).collect():
        got.setdefault(r.offset, []).append(r)
    n_ok = 0
    mismatches = []
    for i, p in enumerate(payloads):
        exp = expected_rows(p)
        rows = got.get(i, [])
        if exp is None:
            ok = len(rows) == 1 and rows[0].verdict == "bad"
        else:
            n_ok += 1
            ok = [tuple(getattr(r, f) for f in FIELDS) for r in sorted(rows, key=lambda r: r.pos)] == exp and all(
                r.verdict == "ok" for r in rows
            )
        if not ok:
            mismatches.append((p, exp, [(r.verdict, r.reason) for r in rows]))
    assert 0.3 * len(payloads) < n_ok < 0.9 * len(payloads)
    assert not mismatches, mismatches[:5]

"""Differential test of the trace-line dialect: Spark (Java regex with (?dU)) against the ``regex`` module with the
expected semantics written out explicitly - ``\\s`` = Unicode White_Space, ``\\d`` = Unicode decimal digit,
``.`` = anything but ``\\n``, leftmost-first captures."""

import random

import regex

from tracelake.operators.logparse import parse_log_lines

# The trace-line pattern with every class made explicit.
WS, NWS, DIG = r"\p{White_Space}", r"\P{White_Space}", r"\p{Nd}"
EXPLICIT = regex.compile(
    rf"^\[[^\]]*\]\{{[^}}]*\}}\[[^\]]*\]{WS}+"
    rf"({DIG}{{4}}-{DIG}{{2}}-{DIG}{{2}}{WS}+{DIG}{{2}}:{DIG}{{2}}:{DIG}{{2}}\.{DIG}+){WS}+"
    rf"([a-zA-Z]){WS}+({NWS}+){WS}+{NWS}+\([^)]*\){WS}*:{WS}*([^\n]*)$"
)

# (accepted, rejected) variants of each slot; a rejected one is drawn with a small probability.
SPACES = ([" ", "  ", "\t", "\u00a0", "\u2003", "\u3000", "\u000b", "\u0085", " \t "], ["\u001c", "\u200b", ""])
DIGITS = ["0123456789", "\u0660\u0661\u0662\u0663\u0664\u0665\u0666\u0667\u0668\u0669",
          "\u0966\u0967\u0968\u0969\u096a\u096b\u096c\u096d\u096e\u096f", "\uff10\uff11\uff12\uff13\uff14\uff15\uff16\uff17\uff18\uff19"]
PREFIX = (["[1]{-1}[-1/-1]", "[43125]{201045}[12/-1]", "[]{}[]", "[a b]{c d}[e]"], ["[1]{-1}", "1]{-1}[-1/-1]", "[x] {y}[z]", "[a]]{b}[c]"])
LEVELS = (["i", "w", "E", "z"], ["ii", "1", "\u00e9", "\u00df", "\U0001F600"])
COMPONENTS = (["Comp", "GlobalRowStore", "A(b)", "x:y", "C\u0001p", "\u03a9", "a\rb", "(", "q)"], [""])
FILES = (["Comp.cpp(00123)", "f(1)", "a(b(2)", "f()", "(7)", "a(b)c(3)"], ["nofile", "f(1", "f(1)x"])
COLONS = ([" : ", ":", " :", ": ", "\u2003:\u00a0"], [" ; ", " "])
MESSAGES = (["msg", "", "   ", "a f(x) : y", "r\rn", "u v\u0085w\u2028z", "tab\there", "ctl\u0001x\u0001", "\u00e9\U0001F600", "end  "], [])


def _pick(rng, slot, p_bad=0.04):
    good, bad = slot
    return rng.choice(bad) if bad and rng.random() < p_bad else rng.choice(good)


def _digits(rng, n, table):
    return "".join(table[rng.randrange(10)] for _ in range(n))


def _line(rng):
    table = rng.choice(DIGITS) if rng.random() < 0.3 else DIGITS[0]
    date = f"{_digits(rng, 4, table)}-{_digits(rng, 2, table)}-{_digits(rng, 2, table)}"
    frac = rng.randint(1, 7) if rng.random() > 0.04 else 0
    time = f"{_digits(rng, 2, table)}:{_digits(rng, 2, table)}:{_digits(rng, 2, table)}.{_digits(rng, frac, table)}"
    return "".join([
        _pick(rng, PREFIX), _pick(rng, SPACES), date, _pick(rng, SPACES), time, _pick(rng, SPACES),
        _pick(rng, LEVELS), _pick(rng, SPACES), _pick(rng, COMPONENTS), _pick(rng, SPACES), _pick(rng, FILES),
        _pick(rng, COLONS), _pick(rng, MESSAGES),
    ])


def test_spark_matches_explicit_semantics(spark):
    rng = random.Random(20240520)
    lines = sorted({_line(rng) for _ in range(4000)})
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "id long, value string")
    got = {r.id: (r.timestamp, r.level, r.component, r.message) for r in parse_log_lines(df, keep=["id"]).collect()}
    expected = {}
    for i, x in enumerate(lines):
        m = EXPLICIT.search(x)
        if m:
            expected[i] = m.groups()
    matched = len(expected)
    assert 0.2 * len(lines) < matched < 0.95 * len(lines)  # the generator exercises both outcomes
    mismatches = [(lines[i], got.get(i), expected.get(i)) for i in set(got) | set(expected) if got.get(i) != expected.get(i)]
    assert not mismatches, mismatches[:5]

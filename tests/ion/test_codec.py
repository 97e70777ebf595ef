import math
import random
from decimal import Decimal

import pytest

from grainstone.sources import ionbinary as B
from grainstone.sources.iontext import TextReader
from grainstone.sources.values import DAY, MINUTE, MONTH, SECOND, YEAR, IonError, Sexp, Struct, Timestamp


def text(s):
    return list(TextReader(s).values())


def binary(data, wanted=None):
    return list(B.BinaryReader(data, wanted).values())


@pytest.mark.parametrize("s, want", [
    ("1 -0 0x1F -0b101 1_000", [1, 0, 31, -5, 1000]),
    ("12.34 1d2 -0.5d-1 12.", [Decimal("12.34"), Decimal("1E2"), Decimal("-0.05"), Decimal("12")]),
    ("1e0 -2.5E3 +inf -inf", [1.0, -2500.0, math.inf, -math.inf]),
    ("true false null null.int null.string", [True, False, None, None, None]),
    (r'"a\n\"é\x41\U0001F600😀\/" "" ' + "'''long '' ''' '''two\\\n'''", ['a\n"éA😀😀/', "", "long '' two"]),
    ("abc 'quoted sym' $3 $10x", ["abc", "quoted sym", "$ion_symbol_table", "$10x"]),
    ("{{AQID}} {{ \"cl\\x41b\" }} {{ '''a''' '''b''' }} {{}}", [b"\1\2\3", "clAb", "ab", b""]),
    ("[1, [2,], ] [] (a + (b) -1 - 'q')", [[1, [2]], [], Sexp(["a", "+", Sexp(["b"]), -1, "-", "q"])]),
    ("{a: 1, 'b c': {}, \"d\": null, '''e''': x, a: 2,}", [Struct([("a", 1), ("b c", Struct()), ("d", None), ("e", "x"), ("a", 2)])]),
    ("a::b::1 'x y'::{z: q::2} // end\n /* 3 */ 4", [1, Struct([("z", 2)]), 4]),
    ("$ion_1_0 $ion_symbol_table::{symbols: [\"s\"]} $10 {$10: $0}", ["s", Struct([("s", None)])]),
    ("$ion_symbol_table::{symbols:[\"s\"]} $ion_symbol_table::{imports: $ion_symbol_table, symbols:[\"t\"]} $11 $ion_1_0 1", ["t", 1]),
])
def test_text(s, want):
    assert text(s) == want


def test_timestamps():
    got = text("2020T 2020-02T 2020-02-03 2020-02-03T 2020-02-03T04:05Z 2020-02-03T04:05:06.789-00:00 2020-02-03T04:05:06+05:30")
    assert [t.precision for t in got] == [YEAR, MONTH, DAY, DAY, MINUTE, SECOND, SECOND]
    assert [t.text() for t in got] == ["2020T", "2020-02T", "2020-02-03", "2020-02-03", "2020-02-03T04:05Z", "2020-02-03T04:05:06.789-00:00", "2020-02-03T04:05:06+05:30"]
    assert got[-1].micros() == Timestamp(SECOND, 2020, 2, 2, 22, 35, 6, "", 0).micros()
    with pytest.raises(IonError):
        got[0].micros()
    assert binary(B.dumps(got)) == got


@pytest.mark.parametrize("s", ['"open', "{a 1}", "[1 2]", "{{A}}", "12a", "$99", "{a: 1", "(1", "null.odd", "'''x", "]", "2020-13-01T00:00Z2"])
def test_faults(s):
    with pytest.raises(IonError):
        text(s)


@pytest.mark.parametrize("values, want", [
    ([1, 2, 3], "21 01 21 02 21 03"),
    ([True, False, True], "11 10 11"),
    ([b"\1\2\3", b"\4\5\6"], "A3 01 02 03 A3 04 05 06"),
    ([[1, 2, 3], [4, 5]], "B6 21 01 21 02 21 03 B4 21 04 21 05"),
    ([Decimal("12.34")], "53 C2 04 D2"),
    ([Struct([("name", "alpha")]), Struct([("name", "beta")])], "D7 84 85 61 6C 70 68 61 D6 84 84 62 65 74 61"),
    ([Timestamp(SECOND, 2020, 1, 2, 3, 4, 5, "678", 0)], "6B 80 0F E4 81 82 83 84 85 C3 02 A6"),
    (["alpha"], "85 61 6C 70 68 61"),
])
def test_binary_bytes(values, want):
    assert B.dumps(values) == B.MARK + bytes.fromhex(want)
    assert binary(B.MARK + bytes.fromhex(want)) == values


def test_binary_oddities():
    read = lambda h: binary(B.MARK + bytes.fromhex(h))
    assert read("2F 8F 1F 0F DF") == [None] * 5
    assert read("00 02 FF FF 21 07") == [7]  # padding
    assert read("D1 83 84 21 05") == [Struct([("name", 5)])]  # ordered struct
    assert read("E4 81 84 21 09") == [9]  # annotation
    assert read("44 3F C0 00 00 40") == [1.5, 0.0]
    assert read("71 04 70") == ["name", None]
    assert binary(B.dumps([Struct([("a", 1)])]) + B.dumps([Struct([("b", 2)])])) == [Struct([("a", 1)]), Struct([("b", 2)])]
    with pytest.raises(IonError):
        read("8E FF 61")


def some(rng, depth):
    k = rng.randrange(12 if depth else 9)
    if k == 0:
        return None
    if k == 1:
        return rng.random() < 0.5
    if k == 2:
        return rng.choice([1, -1]) * rng.getrandbits(rng.choice([3, 8, 31, 64, 200]))
    if k == 3:
        return rng.choice([0.0, -0.0, 1.5, 1e300, -2.5e-10, math.inf, rng.random()])
    if k == 4:
        return Decimal(rng.randint(-(10**20), 10**20)).scaleb(rng.randint(-25, 5))
    if k in (5, 6):
        return "".join(rng.choice("aé\n\\\"'😀 z") for _ in range(rng.choice([0, 3, 13, 14, 200])))
    if k == 7:
        return rng.randbytes(rng.choice([0, 5, 14, 300]))
    if k == 8:
        o = rng.choice([None, 0, 330, -480])
        return Timestamp(SECOND, rng.randint(1900, 2100), rng.randint(1, 12), rng.randint(1, 28), rng.randrange(24), rng.randrange(60), rng.randrange(60), rng.choice(["", "5", "000", "123456789"]), o)
    if k == 9:
        return [some(rng, depth - 1) for _ in range(rng.randrange(4))]
    if k == 10:
        return Sexp(some(rng, depth - 1) for _ in range(rng.randrange(3)))
    return Struct((rng.choice(["a", "name", "b c", "é", "null"]), some(rng, depth - 1)) for _ in range(rng.randrange(4)))


def test_random_values_round_trip():
    rng = random.Random(0)
    values = [some(rng, 4) for _ in range(2000)]
    assert list(map(repr, binary(B.dumps(values)))) == list(map(repr, values))


def test_only_wanted_fields_are_read():
    data = B.dumps([Struct([("a", 1), ("b", [Struct([("a", 2)])]), ("c", "x")]), None])
    assert binary(data, frozenset({"b"})) == [Struct([("b", [Struct([("a", 2)])])]), None]
    assert binary(data, frozenset()) == [Struct(), None]


def test_transcoding():
    s = '{id: 1, l: [1.5, "x"], s: sym, t: 2020-01-01T00:00:00Z} [2] null'
    assert binary(B.transcode(s)) == text(s)

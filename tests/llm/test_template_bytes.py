"""Template words hashed from bytes, and names found from blank to blank, against plain forms."""

import random
import re

from pelagia.llm import decontam

CAPITAL = "|".join(re.escape(chr(c)) for c in [*range(65, 91), *range(0xC0, 0x180), *range(0x386, 0x3AC), *range(0x400, 0x430)] if chr(c).isupper()).encode()
IN = rb"A-Za-z0-9\x80-\xff"
NAME = re.compile(rb"(?<=[a-z0-9,;\x80-\xff] )(?:" + CAPITAL + rb")(?:[a-z]|[\xc3-\xf4][\x80-\xbf]+)+(?![" + IN + rb"])")
ODD = ["", "\x01 a Ann", "xx Paul Ann Bob, Élan Ωmega Жук Ånd", "a MćDonald 5 kg of 12,5 km on 3rd at Paris-Ann", "a\x00 b \x00a", "a  Bé Ñé\tÑandú ; Ab"]


def texts():
    r, letters = random.Random(1), [*"ab AZé Ñ12,.;kgm \t\nΩЖ’'x\x00", " kg", " Ann"]
    return ODD + ["".join(r.choice(letters) for _ in range(80)) for _ in range(2000)]


def test_words_are_hashed_from_bytes():
    seen = {}
    for t in texts():
        words, (known, slot) = decontam.template(t)[0], decontam.hashed(decontam._replaced(t)[0])
        assert len(known) == len(words) and slot.tolist() == [w in decontam.PLACEHOLDERS for w in words]
        assert all(seen.setdefault(w, h) == h for w, h in zip(words, known.tolist()))
    assert len(set(seen.values())) == len(seen) > 5000


def test_names_are_those_of_the_plain_pattern():
    found = 0
    for t in texts():
        raw = b" ".join(t.encode().translate(None, b"\x01\x02\x03\x04").split())
        assert decontam._NAME.findall(raw) == NAME.findall(raw) and decontam._NAME.sub(b" \x01", raw) == NAME.sub(b"\x01", raw)
        found += len(NAME.findall(raw))
    assert found > 500

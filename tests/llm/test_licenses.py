"""License scans against a brute-force search of phrases and notices."""

import random
import re

import pytest
from pyspark.sql import functions as F

from edge_docs import frame, prose, rows
from locus.llm import licenses, queries
from locus.llm.ascii_words import pieces
from locus.llm.license_texts import PHRASES, Template

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
CLASHES = ["n_words", "spans", "found", "template", "diagonal", "places", "start", "near_id", "near_hash", "label", "a.b", "text_", "first"]


def words_of(text):
    return WORDS.findall((text or "").translate(LOWER))


def places(text, phrase):
    words, want = words_of(text), words_of(phrase)
    return [i for i in range(len(words) - len(want) + 1) if words[i:i + len(want)] == want]


def distance(template, words):
    """Least edits of words between the template and any stretch of ``words``."""
    row = [0] * (len(words) + 1)
    for i, a in enumerate(template, 1):
        new = [i]
        for j, b in enumerate(words, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def licensed():
    rng = random.Random(11)
    out = rows()
    notices = [t.text for t in licenses.NOTICES]
    for i, notice in enumerate(notices):
        out.append((1000 + i, f"{prose(rng, 30)}\n{notice.upper() if i % 2 else notice}\n{prose(rng, 30)}"))
        words = notice.split()
        if len(words) > 18:
            words[7] = "changed"
            del words[12]
            out.append((1100 + i, " ".join([prose(rng, 9), *words, prose(rng, 9)])))
    out += [(1200, "cc by cc by cc-by CC: by mit license MIT LICENSEs mitlicense"), (1201, "GNU General Public"),
            (1202, "gnu gnu general public license general public license"), (1203, "Apache License " * 400),
            (1204, "the MIT License"), (1204, "the MIT License"), (None, "the MIT License"), (None, "the MIT License"),
            (1205, "ａpache license"), (1206, "apache\x00license\x7fmit license"), (1207, "x" * 70000 + " mit " + " license " + "y " * 40000 + "cc by"),
            (1208, "a " * 16000 + "gnu general public license" + " b" * 20000)]
    return out


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


def test_pieces_give_every_word_once():
    rng = random.Random(1)
    for _ in range(200):
        text = "".join(rng.choice("ab Z-é😀9 ") for _ in range(rng.randint(0, 90)))
        for carry in (0, 1, 4):
            got, last = [], 0
            for first, old, words in pieces(text.encode(), carry, 7):
                assert first == last - old and old <= carry
                assert [w for w in words[:old]] == got[len(got) - old:]
                got += words[old:]
                last = first + len(words)
            assert [w.decode() for w in got] == words_of(text)


def test_base_places_and_labels_equal_brute_force(spark, monkeypatch, tmp_path):
    pairs = licensed()
    clashing(frame(spark, pairs)).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_license_scan(spark, str(tmp_path)).collect()
    want = []
    for i, t in pairs:
        found = sorted((p, x.label) for x in PHRASES for p in places(t, x.text))
        want.append((i, len(words_of(t)), len(found), found[0][0] if found else None, found[-1][0] if found else None,
                     ",".join(sorted({x for _, x in found}))))
    assert sorted(map(repr, [tuple(r)[:6] for r in got])) == sorted(map(repr, want))
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)


def test_notices_are_found_as_brute_force_finds_them(spark):
    pairs = licensed()
    got = {}
    for r in licenses.scan(clashing(frame(spark, pairs))).collect():
        got.setdefault((r.doc_id, r.n_words), set()).update(x["template"] for x in r.spans)
    found = near = 0
    for i, t in pairs:
        words = words_of(t)[:3000]
        for n, template in enumerate(licenses.TEMPLATES):
            want = words_of(template.text)
            # An unchanged or lightly changed notice; phrases and notices of a few words must stand whole.
            edits = distance(want, words)
            if edits == 0 or not template.exact and len(want) > 18 and edits <= 2:
                assert n in got[i, len(words_of(t))], (i, template)
                found += edits == 0
                near += edits > 0
            if template.exact or edits > 0.2 * len(want):
                assert edits == 0 or len(words_of(t)) > 3000 or n not in got[i, len(words_of(t))], (i, template)
    assert found > 25 and near > 5


def test_spans_name_the_place_of_a_changed_notice(spark):
    notice = Template("own", " ".join(f"w{i}" for i in range(40)))
    body = [f"w{i}" for i in range(40)]
    changed = body[:10] + ["extra"] + body[10:20] + body[22:30] + ["other"] + body[31:]
    text = " ".join(["a"] * 13 + changed + ["z"] * 9)
    [row] = licenses.scan(frame(spark, [(1, text)]), [notice]).collect()
    [span] = row.spans
    assert (span.start, span.end, span.label) == (13, 13 + len(changed), "own")
    assert span.similarity == pytest.approx(1 - 4 / 40)
    assert licenses.scan(frame(spark, [(1, text)]), [notice], similarity=0.95).collect()[0].spans == []


def test_copies_and_pieces_do_not_add_votes(spark, monkeypatch):
    text = "lead " * 9000 + "released under the mit license" + " tail" * 9000
    out = licenses.scan(frame(spark, [(7, text)] * 3 + [(8, "released under the mit licence")])).collect()
    assert [[(x.label, x.start) for x in r.spans] for r in out if r.doc_id == 7] == [[("mit", 9000), ("mit", 9003)]] * 3
    # Four of five words: alike enough, but no window of five votes for it.
    assert [r.spans for r in out if r.doc_id == 8] == [[]]


def test_empty_tables_and_templates(spark):
    assert licenses.scan(frame(spark, [])).count() == 0
    [row] = licenses.scan(frame(spark, [(1, "mit license")]), []).collect()
    assert (row.n_words, row.spans) == (2, [])
    with pytest.raises(ValueError):
        licenses.scan(frame(spark, []), [Template("x", "word", True)])

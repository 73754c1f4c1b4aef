"""Spelling variants, conversation repair and toxicity against brute force and held-out accuracy."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pairsmith.llm import conversation_repair, spelling, toxicity

SF = "/root/testdata/sf0.001"
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))


# --- spelling --------------------------------------------------------------------------------

def brute_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if c >= 5 and len(w) >= 6}


def brute_near(word, words):
    out = set()
    letters = set("".join(words)) if len(words) < 50 else LETTERS
    for i in range(len(word) + 1):
        out.add(word[:i] + word[i + 1:])
        for c in letters:
            out.add(word[:i] + c + word[i:])
            out.add(word[:i] + c + word[i + 1:])
    return (out & words.keys()) - {word}


def brute_variants(words):
    out, form = {}, {}
    for w, n in words.items():
        near = brute_near(w, words)
        best = min(near, key=lambda x: (-words[x], x)) if near else None
        form[w] = best if near and words[best] >= 5 * n else None
        out[w] = [n, len(near), form[w], words[form[w]] if form[w] else None]
    for w in out:
        root = w
        while form[root]:
            root = form[root]
        out[w].append(root)
    return {w: tuple(x) for w, x in out.items()}


def as_dict(df):
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in rows}


def test_variants_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    words = brute_words([(r.doc_id, r.text) for r in docs.collect()])
    got = as_dict(spelling.op11_spelling_variants(spark, SF))
    assert len(words) > 500 and got == brute_variants(words)
    assert sum(x[2] is not None for x in got.values()) > 5


@pytest.mark.parametrize("block", [2, 4096])
def test_variants_of_few_letters(spark, monkeypatch, block):
    """Many words under every half: cut into pieces or not, all pairs are found once."""
    monkeypatch.setattr(spelling, "BLOCK", block)
    rng = random.Random(5)
    words = {"".join(rng.choice("abÿ") for _ in range(rng.randint(6, 9))): rng.choice([5, 5, 25, 130, 700, 4000]) for _ in range(300)}
    got = as_dict(spelling.variants(spark.createDataFrame(list(words.items()), "word string, n long")))
    assert got == brute_variants(words)
    assert any(x[4] not in (x[2], w) for w, x in got.items())  # a chain of more than one step


def test_words_of_odd_rows(spark, odd, nothing):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert {r.word: r.n for r in spelling.corpus_words(odd).collect()} == brute_words(rows)
    assert spelling.variants(spelling.corpus_words(nothing)).count() == 0


def test_long_texts_and_many_words_in_pieces(spark, odd, monkeypatch):
    monkeypatch.setattr(spelling, "_FEW", 100)
    monkeypatch.setattr(spelling, "HELD", 10)
    assert {r.word: r.n for r in spelling.corpus_words(odd).collect()} == brute_words([(r.doc_id, r.text) for r in odd.collect()])


def test_case_of_other_letters_stays(spark):
    docs = spark.createDataFrame([(i, "ÉTUDES études Kelvins") for i in range(1, 7)], "doc_id long, text string")
    assert {r.word for r in spelling.corpus_words(docs).collect()} == {"Études", "études", "elvins"}


# --- conversations ---------------------------------------------------------------------------

GRAMMAR = re.compile("(s?(ua)+)?")


def exhaustive(symbols):
    """All edit scripts with at most two rows inserted in each gap."""
    best = None
    gaps = ["", "u", "a", "ua", "au"]
    ways = [[("", 4, "D")] + ([] if s == "x" else [(s.lower(), 3 * s.isupper(), "K")] + [(r, 3 + 3 * s.isupper(), "R") for r in "ua"]) for s in symbols]
    for choice in itertools.product(*ways):
        for put in itertools.product(gaps, repeat=len(symbols) + 1):
            roles = put[0] + "".join(c[0] + p for c, p in zip(choice, put[1:]))
            if GRAMMAR.fullmatch(roles):
                cost = sum(c[1] for c in choice) + 3 * sum(map(len, put))
                audit = "I" * len(put[0]) + "".join(c[2] + "I" * len(p) for c, p in zip(choice, put[1:]))
                best = min(best or (cost, audit), (cost, audit))
    return best


def by_states(symbols):
    """The same by a plain automaton over (nothing, after s, after u, after a) with whole audits."""
    go = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def insert(best):
        for _ in range(4):
            for state, (cost, audit) in list(best.items()):
                for r in "ua":
                    if r in go[state]:
                        to, new = go[state][r], (cost + 3, audit + "I")
                        best[to] = min(best.get(to, new), new)
        return best

    best = insert({0: (0, "")})
    for s in symbols:
        after = {}
        for state, (cost, audit) in best.items():
            ways = [(state, 4, "D")]
            if s != "x":
                late = 3 * s.isupper()
                ways += [(go[state].get(s.lower()), late, "K")] + [(go[state].get(r), 3 + late, "R") for r in "ua"]
            for to, more, edit in ways:
                if to is not None:
                    new = (cost + more, audit + edit)
                    after[to] = min(after.get(to, new), new)
        best = insert(after)
    return min(v for k, v in best.items() if k in (0, 3))


def test_parse_equals_all_edit_scripts():
    rng = random.Random(3)
    cases = {"", *"suaoxSUAO", *("".join(rng.choice("suaoxSUAO") for _ in range(rng.randint(2, 3))) for _ in range(60))}
    for symbols in cases:
        assert conversation_repair.parse(symbols) == exhaustive(symbols) == by_states(symbols), symbols


def test_parse_of_longer_conversations():
    rng = random.Random(4)
    for _ in range(1500):
        symbols = "".join(rng.choice("suauauaoxSUA") for _ in range(rng.randint(4, 25)))
        cost, audit = conversation_repair.parse(symbols)
        assert (cost, audit) == by_states(symbols), symbols
        roles = "".join((role or {"s": "s", "u": "u", "a": "a"}[symbols[i].lower()])[0] for i, role in conversation_repair.edits(symbols, audit))
        assert GRAMMAR.fullmatch(roles)


def test_parse_of_a_very_long_conversation():
    cost, audit = conversation_repair.parse("ua" * 50_000 + "a" + "ua" * 50_000)
    assert cost == 3 and len(audit) == 200_002 - audit.count("D") + audit.count("D")


def brute_repair(rows, ids):
    """rows: (conv_id, turn, role, text) after damage."""
    out = {}
    for conv in ids:
        own = [(t, r if r is not None else " ", x if x is not None else " ") for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        blank = duplicate = truncated = 0
        symbols, seen = "", set()
        for _, role, text in own:
            shown = re.sub("[\x20\x09-\x0D]+", "", text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else ""
            seen.add((role, text))
            blank, duplicate, truncated = blank + (fault == "blank"), duplicate + (fault == "duplicate"), truncated + (fault == "truncated")
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            symbols += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = by_states(symbols)
        lines, read, place = [], 0, 0
        for edit in audit:
            role, text = (None, "") if edit == "I" else own[read][1:]
            read += edit != "I"
            if edit == "D":
                continue
            if not (edit == "K" and role.startswith("s")):
                role, place = (role if edit == "K" else ("user", "assistant")[place % 2]), place + 1
            lines.append(f"{role}:{text}")
        out[conv] = (gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        role, text = " " if role is None else role, " " if text is None else text
        fault = zlib.crc32(key.encode()) % 20
        if fault == 0:
            continue
        if fault == 1:
            text = ""
        if fault == 2:
            text = re.sub("[.!?]", "", text)
        if fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if fault == 3 else 1)
    return out


def repaired_rows(df):
    rows = df.collect()
    assert len({r.conv_id for r in rows}) == len(rows)
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_repair_of_the_conversations(spark, sf):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in spark.read.parquet(f"{sf}/conversations.parquet").collect()]
    got = repaired_rows(conversation_repair.op12_conversation_repair(spark, sf))
    assert got == brute_repair(brute_damage(rows), {r[0] for r in rows})
    assert any(x[5] for x in got.values())


ODD_TURNS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "assistant", "Yes? \n"), (1, 2, "assistant", "Yes? \n"), (1, None, "user", "First."),
    (2, 5, None, "x."), (2, 6, "user", None), (2, None, None, None), (None, 1, "user", "No id."), (None, 1, "assistant", "None at all."),
    (3, None, "user", "a."), (3, None, "assistant", "b"), (4, 1, "", "c."), (4, 9, "tool", "d."), (4, 3, "System", "e."), (4, 4, "support", "f."),
    (5, 1, "user", "\t\n"), (6, 1, "assistant", " "), (6, -3, "user", "g" * 200_000 + "!"), (7, 1, "user", "h."), (7, 1, "user", "h."), (7, 1, "user", "h."),
]


def odd_turns(spark, rows=ODD_TURNS):
    data = [(*r, "key", 1, [1]) for r in rows]
    return spark.createDataFrame(data, "conv_id long, turn long, role string, text string, row string, cost int, edits array<int>")


def with_hash(df):
    return df.withColumn("repaired_sha256", F.sha2(F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n"), 256))


def test_repair_of_odd_rows(spark):
    ids = spark.createDataFrame([(None,), (1,), (99,)], "conv_id long")
    known = {r[0] for r in ODD_TURNS}
    assert repaired_rows(with_hash(conversation_repair.repair(odd_turns(spark)))) == brute_repair(ODD_TURNS, known)
    got = repaired_rows(with_hash(conversation_repair.repair(odd_turns(spark), ids)))
    assert got == brute_repair(ODD_TURNS, known | {99})
    assert got[99] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert conversation_repair.repair(odd_turns(spark).where("false")).count() == 0


def test_damage_of_odd_rows(spark):
    rows = [*ODD_TURNS, *((c, t, "user" if t % 2 == 0 else "assistant", f"Text {t}? Or {c}.") for c in range(20, 40) for t in range(9))]
    got = [(r.conv_id, r.turn, r.role, r.text) for r in conversation_repair.damaged(odd_turns(spark, rows)).collect()]
    assert Counter(got) == Counter(brute_damage(rows))


# --- toxicity --------------------------------------------------------------------------------

def test_toxic_documents_held_out(spark):
    sf = "/root/testdata/sf0.1"
    judged = toxicity.op13_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id", "left").collect()
    assert len(judged) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in judged)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in judged)
    held = [r for r in judged if r.held_out and r.toxic is not None]
    toxic, clean = [r for r in held if r.toxic], [r for r in held if not r.toxic]
    assert len(toxic) > 100 and sum(r.predicted for r in toxic) >= 0.85 * len(toxic) and sum(r.predicted for r in clean) <= 0.01 * len(clean)


def bags(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        sentences = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(6)) for _ in range(rng.randint(1, 6))]
        toxic = i % 4 == 0
        if toxic:
            sentences[rng.randrange(len(sentences))] += " nastyword"
        rows.append((i, ". ".join(sentences) + ".", int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string, toxic int")


def test_offending_sentences_are_located(spark):
    docs = bags(spark)
    found = toxicity.score(docs, toxicity.fit(docs)).join(docs.select("doc_id", "toxic", "text"), "doc_id").collect()
    for r in found:
        assert (r.score >= 0.3) == bool(r.toxic)
        assert [o.text for o in r.offending] == [s.strip(". ") for s in r.text.split(". ") if "nastyword" in s]
        assert all(r.text.split(". ")[o.sentence].strip(".") == o.text for o in r.offending)


def test_score_is_the_noisy_or_of_sentences(spark):
    docs = bags(spark)
    model = toxicity.fit(docs)
    import pyarrow as pa
    text = docs.first().text
    s = toxicity.Sentences(pa.array([text, "", None]))
    p = model.sentence_scores(s)
    rest = 1.0
    for x in p:
        rest *= 1 - x
    assert abs(model.document_scores(s, p)[0] - (1 - rest)) < 2e-6 and list(model.document_scores(s, p)[1:]) == [0, 0]


def test_toxicity_of_odd_rows(spark, odd, nothing):
    model = toxicity.fit(bags(spark))
    got = toxicity.score(odd, model).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0 and r.n_sentences == 0 for r in got if r.doc_id in (2, 3, 7))
    assert toxicity.score(nothing, model).count() == 0


def test_labels_of_one_kind_or_none(spark, odd):
    none = toxicity.fit(odd.where("false").select("text", F.lit(1).alias("toxic")))
    clean = toxicity.fit(odd.select("text", F.lit(0).alias("toxic")))
    toxic = toxicity.fit(odd.select("text", F.lit(1).alias("toxic")))
    assert {r.score for r in toxicity.score(odd, none).collect()} == {0} == {r.score for r in toxicity.score(odd, clean).collect()}
    assert all(0 <= r.score <= 1 for r in toxicity.score(odd, toxic).collect())

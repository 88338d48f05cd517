"""Line-frequency rules and weighted sampling against plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from millrace.llm.line_frequency import LineRules, line_frequency_rules, remove_frequent_lines
from millrace.llm.weighted_sampling import weighted_fingerprints

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RULES = LineRules(min_documents=2, host_share=0.1)
SCHEMA = "doc_id bigint, text string, source string, n_words string, _hash int, position int"


def random_docs(n, seed=1):
    draw = random.Random(seed)
    common = ["Home |  News | Login", "© 2020 all rights"]
    rows = []
    for k in range(n):
        lines = [" ".join(draw.choices("a b c dd é 漢 # %x".split(), k=draw.randint(0, 9)))
                 for _ in range(draw.randint(0, 6))]
        lines += [c.upper() if draw.random() < 0.3 else c for c in common if draw.random() < 0.4]
        draw.shuffle(lines)
        rows.append((k, draw.choice(["\n", "\n\n"]).join(lines), draw.choice(["h1", "h2", None])))
    return rows + [
        (900, None, "h1"), (901, "", "h1"), (902, " \t\n ", None), (903, "w " * 30_000, "h2"),
        (904, " ".join(f"w{i % 7000}" for i in range(20_000)), "h2"), (905, "one\vtwo", "h2"),
        (None, "no id\nno id", "h1"), (3, rows[3][1], rows[3][2]), (3, "other text", "h1"),
    ]


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, 2) for row in rows], SCHEMA)


def brute(rows, rules):
    holders, hosts = defaultdict(set), defaultdict(set)
    for k, text, host in rows:
        hosts[host].add(k)
        for line in (text or "").split("\n"):
            words = WORD.findall(line)
            if words:
                holders[host, " ".join(words).lower()].add(k)
    out = Counter()
    for k, text, host in rows:
        text = text or ""
        words, removed, seen, dups = WORD.findall(text), 0, set(), 0
        for line in text.split("\n"):
            own = WORD.findall(line)
            if own:
                n = len(holders[host, " ".join(own).lower()])
                if n > rules.min_documents and n > rules.host_share * len(hosts[host]):
                    removed += len(own)
                dups += line in seen
                seen.add(line)
        grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
        many, covered = Counter(grams), set()
        for i, g in enumerate(grams):
            if many[g] > 1:
                covered.update(range(i, i + 5))
        failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
        left = len(words) - removed
        kept = not failed and left >= 10 and left >= 0.5 * len(words)
        out[(k, len(words), sum(map(len, words)), sum(map(text.count, "#*$%&|<>")), dups,
             len(covered), removed, failed, kept)] += 1
    return out


@pytest.mark.parametrize("limit", [None, 0])
def test_line_rules_equal_brute_force(spark, limit):
    rows = random_docs(120)
    got = line_frequency_rules(frame(spark, rows), RULES, limit=limit).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "removed_words", "base_failed", "kept").collect()
    want = brute(rows, RULES)
    assert Counter(map(tuple, got)) == want
    assert sum(w[-1] for w in want) > 20 and any(w[6] for w in want)


@pytest.mark.parametrize("limit", [None, 0])
def test_texts_come_without_their_frequent_lines(spark, limit):
    rows = random_docs(120)
    holders, hosts = defaultdict(set), defaultdict(set)

    def norm(line):
        return " ".join(WORD.findall(line)).lower()

    for k, text, host in rows:
        hosts[host].add(k)
        for line in (text or "").split("\n"):
            if norm(line):
                holders[host, norm(line)].add(k)
    want = Counter()
    for k, text, host in rows:
        left = None if text is None else "\n".join(
            line for line in text.split("\n") if not norm(line) or not (
                len(holders[host, norm(line)]) > max(
                    RULES.min_documents, RULES.host_share * len(hosts[host]))))
        want[k, left] += 1
    got = remove_frequent_lines(frame(spark, rows), RULES, limit=limit).select("doc_id", "text").collect()
    assert Counter(map(tuple, got)) == want
    assert sum(left != text for (_, left), (_, text, _) in zip(want, rows)) > 10


def test_a_repeated_line_goes_in_small_and_hot_hosts(spark):
    line, own = "read more in our newsletter", "word {} stands here alone with ten other words of its own"
    rows = [(k, f"{line}\n{own.format(k)}" if k < 110 else own.format(k), "hot") for k in range(12_000)]
    rows += [(20_000 + k, f"{line}\n{own.format(k)}", "small") for k in range(110)]
    got = remove_frequent_lines(frame(spark, rows)).filter("doc_id < 110 OR doc_id >= 20000")
    assert {r.text for r in got.collect()} == {own.format(k) for k in range(110)}


def test_line_rules_of_an_empty_table(spark):
    assert line_frequency_rules(frame(spark, []), RULES).count() == 0


def test_main_paths_run_without_python(spark):
    docs = frame(spark, random_docs(5))
    for df in (line_frequency_rules(docs, RULES), weighted_fingerprints(docs, 4)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def jaccard(a, b):
    a, b = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def test_fingerprints_estimate_generalised_jaccard(spark):
    rows = random_docs(60, seed=2)
    got = weighted_fingerprints(frame(spark, rows)).collect()
    assert len(got) == len(rows)

    def place(row):
        text = row[1] or ""
        label = f"{'none' if row[0] is None else row[0]}:{text}"
        return (row[0] is not None, row[0] or 0, hashlib.md5(label.encode()).digest())

    order = sorted({(k, t or "") for k, t, _ in rows}, key=place)
    errors, prints = [], {}
    by = defaultdict(list)
    for row in got:
        by[row.doc_id, row.n_chars].append(row)
    for at, (k, text) in enumerate(order):
        following = order[at - 1][1]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + following[:cut]
        digest = hashlib.sha256(edited.encode()).hexdigest()
        row = next(r for r in by[k, len(text)] if r.edited_sha256 == digest)
        assert len(row.fingerprint) == (256 if WORD.search(text) else 0)
        assert prints.setdefault(text, row.fingerprint) == row.fingerprint
        errors += [row.near_edited - jaccard(text, edited), row.near_next - jaccard(text, following)]
        if edited == text:
            assert row.near_edited == 1.0 and row.edited_fingerprint == row.fingerprint
    assert abs(sum(errors) / len(errors)) < 0.03
    assert sum(e * e for e in errors) / len(errors) < 0.1 ** 2


def test_fingerprints_of_few_rows(spark):
    assert weighted_fingerprints(frame(spark, [])).count() == 0
    row, = weighted_fingerprints(frame(spark, [(1, "abc def ghi", "s")])).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abc def abc").hexdigest()
    assert row.near_next == 1.0

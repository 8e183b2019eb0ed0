import random

from recallset.llm import line_dedup


def crowd(n):
    """Lines that swap two words of a common one, unlike each other in most pairs, and for some a later one with another last word."""
    pick = random.Random(5)
    lines = []
    for _ in range(n):
        words = [f"word{i}" for i in range(60)]
        a, b = pick.sample(range(5, 55), 2)
        words[a], words[b] = words[b], words[a]
        lines.append(words)
    lines += [[*words[:-1], f"other{i}"] for i, words in enumerate(lines[::7])]
    return [" ".join(words) for words in lines]


def shingles(line):
    words = line.split(" ")
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def test_unlike_lines_of_a_crowded_token_are_not_paired(spark, monkeypatch):
    lines = crowd(60)
    sets = [shingles(line) for line in lines]
    alike = [(a, b) for b in range(len(sets)) for a in range(b) if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    later, paired = line_dedup._later, []
    monkeypatch.setattr(line_dedup, "_later", lambda pairs, *rest: paired.append(pairs.count()) or later(pairs, *rest))
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = {r.doc_id for r in line_dedup.report(docs).filter("n_removed > 0").collect()}
    assert found == {b for _, b in alike}
    assert len(alike) >= 9 and paired[-1] < 4 * len(alike) < len(lines) ** 2 // 8


def test_sketches_rule_out_no_similar_pair(spark):
    rows = [(k, 0, [*range(1000 * k, 1000 * k + n), *range(10**6 * j, 10**6 * j + more)]) for k in range(3) for n in (9, 80, 1500) for j, more in ((k + 7, n // 9), (k + 17, n // 10))]
    rows = [(i, g, tokens) for i, (_, g, tokens) in enumerate(rows)]
    members = spark.createDataFrame(rows, "h long, g long, tokens array<long>")
    found = {r.h: r for r in line_dedup._sketches(members).collect()}
    for x, _, one in rows:
        for y, _, two in rows:
            shared = len({*one} & {*two})
            differ = sum(((found[x][f"s{k}"] ^ found[y][f"s{k}"]) & (1 << 64) - 1).bit_count() for k in range(line_dedup.SKETCH))
            assert differ <= len(one) + len(two) - 2 * shared
            if 180 * shared >= 80 * (len(one) + len(two)):
                assert 180 * differ <= 20 * (len(one) + len(two))


def test_plans_do_not_carry_a_megabyte_of_ranks(spark):
    docs = spark.createDataFrame([(1, "one two three four five six")], "doc_id long, text string")
    rows = line_dedup.with_tokens(line_dedup.lines_of(docs, 1), line_dedup.rarity(docs))
    assert len(rows._jdf.queryExecution().executedPlan().toString()) < 600_000

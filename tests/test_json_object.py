"""One JSON object read in splits of any size, against the json module."""

import json
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagshelf.plans import pipeline
from tagshelf.sources import json_object
from tagshelf.sources.records import _object_records, read_games


@pytest.fixture
def split_at(spark):
    """Set how many bytes a split has."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum"]

    def set_bytes(n):
        for name, value in zip(names, (n, 0, 1), strict=True):
            spark.conf.set(name, value)

    yield set_bytes
    for name in names:
        spark.conf.unset(name)


def some_value(depth=0):
    kinds = [lambda: random.randint(-5, 10**6), lambda: None, lambda: True, lambda: some_text()]
    if depth < 3:
        kinds += [lambda: [some_value(depth + 1) for _ in range(random.randint(0, 3))]] * 2
        kinds += [lambda: {some_text(): some_value(depth + 1) for _ in range(random.randint(0, 3))}] * 3
    return random.choice(kinds)()


def some_text():
    return "".join(random.choices(["a", "}", "{", "]", "[", ",", '"', "\\", "\\\\", "\n", "é", "😀", ":", " ", '\\"', "\\}"], k=random.randint(0, 6)))


def dumped(pairs):
    gap = lambda: random.choice(["", "", " ", "\n", "\t \r\n"])
    parts = [f"{gap()}{json.dumps(k, ensure_ascii=random.random() < 0.5)}{gap()}:{gap()}{json.dumps(v, ensure_ascii=random.random() < 0.5)}{gap()}" for k, v in pairs]
    return gap() + "{" + ",".join(parts) + "}" + gap()


def entries_of(texts, n_bytes):
    """What the two readings find, with splits of so many bytes: (file, block, place, entry), or None if a file is refused."""
    batches = []
    for file, text in enumerate(texts):
        raw, at, splits = text.encode(), 0, {}
        while at < len(raw):
            end = raw.find(b"}", at)
            end = len(raw) if end < 0 else end
            splits.setdefault(at // n_bytes * n_bytes, []).append(raw[at:end])
            at = end + 1
        for block, rows in splits.items():
            # The rows of a split come in several batches, and a batch has rows of several splits.
            for part in (rows[:2], rows[2:]) if n_bytes % 2 else (rows,):
                if part:
                    columns = [[file] * len(part), [len(raw)] * len(part), [block] * len(part)]
                    batches.append(pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns], pa.array(part, pa.binary())], list("abcd")))
    if len(batches) > 3 and n_bytes % 3 == 0:
        batches[:2] = [pa.Table.from_batches(batches[:2]).combine_chunks().to_batches()[0]]
    changes = [r for b in json_object._changes(iter(batches)) for r in b.to_pylist()]
    states, broken = json_object.entry_states(changes)
    found = [r for b in json_object._entries(iter(batches), states) for r in b.to_pylist()] if not broken else []
    if broken or any(r["kind"] == "broken" for r in found):
        return None
    out, begun = [], []
    for r in found:
        if r["kind"] == "entry":
            out.append((r["file"], r["block"], r["place"], r["entry"]))
            continue
        begun.append(r)
        if r["kind"] == "head":
            assert [x["kind"] for x in begun] == ["tail", *["middle"] * (len(begun) - 2), "head"]
            out.append((r["file"], begun[0]["block"], begun[0]["place"], "".join(x["entry"] for x in begun)))
            begun = []
    assert not begun
    return sorted(out)


def some_files():
    random.seed(21)
    for n in (0, 1, 5, 30, 30, 2):
        yield [(f"k{j}{some_text()}", {"v": some_value()} if random.random() < 0.8 else some_value()) for j in range(n)]


@pytest.mark.parametrize("n_bytes", [1, 2, 3, 7, 9, 20, 64, 301, 1 << 20])
def test_entries_are_those_of_the_file_for_any_split(n_bytes):
    wanted = list(some_files())
    got = [[] for _ in wanted]
    for file, _, _, entry in entries_of([dumped(p) for p in wanted], n_bytes):
        got[file] += json.loads("{" + entry + "}").items()
    assert got == wanted


def test_entries_on_files(spark, tmp_path, split_at):
    wanted = list(some_files())[2:]
    for i, pairs in enumerate(wanted):
        (tmp_path / f"{i}.json").write_text(dumped(pairs), encoding="utf-8")
    split_at(600)
    rows = json_object.read_entries(spark, str(tmp_path)).orderBy("file", "block", "place").collect()
    got = [[] for _ in wanted]
    for r in rows:
        got[r["file"]] += json.loads("{" + r["entry"] + "}").items()
    assert got == wanted
    assert len({(r["file"], r["block"]) for r in rows}) > len(wanted)


BROKEN = [
    "{}{}", '{"a":{}}{"b":{}}', "[1]", '[{"a":1}]', '{"a":1', '{"a":{}', '{"a":{}}}', '{"a":"b}', "  \n", '"a"', "5", 'x{"a":{}}',
    '{"a":{}}x', '{"a":{},,"b":{}}', '{"a":{},}', '{"a":[}]', "}{", '{"a":{},"b":1',
]


@pytest.mark.parametrize("n_bytes", [1, 4, 5, 1 << 20])
def test_what_is_no_object_is_refused(n_bytes):
    for text in BROKEN:
        found = entries_of(['{"1": {"name": "a"}}', text], n_bytes)
        if found is not None:  # what stands inside an entry, its parser refuses
            with pytest.raises(ValueError):
                [json.loads("{" + e + "}") for _, _, _, e in found if e.strip()] + [json.loads(e) for _, _, _, e in found if not e.strip()]


def test_a_broken_file_is_named(spark, tmp_path):
    (tmp_path / "good.json").write_text('{"1": {"name": "a"}}')
    for text in BROKEN[:2] + BROKEN[4:6] + BROKEN[13:14]:
        (tmp_path / "broken.json").write_text(text)
        with pytest.raises(ValueError, match="not a JSON object.*broken.json"):
            read_games(spark, str(tmp_path), "object").collect()


@pytest.mark.parametrize("text", ["{}", " { \n}\n", "{\n}"])
def test_an_object_without_entries(spark, tmp_path, split_at, text):
    (tmp_path / "x.json").write_text(text)
    split_at(2)
    assert json_object.read_entries(spark, str(tmp_path)).count() == 0


def test_a_repeated_key_keeps_its_first_place_and_last_value(spark, tmp_path, split_at):
    text = '{"1": {"name": "old"}, "2": {"name": "two"}, "\\u0031": {"name": "new"}, "3": {"name": "three"}}'
    (tmp_path / "x.json").write_text(text)
    for n_bytes in (30, 1 << 20):
        split_at(n_bytes)
        rows = read_games(spark, str(tmp_path), "object").orderBy("record_ord").collect()
        assert [(r["appid"], r["name"]) for r in rows] == [("1", "new"), ("2", "two"), ("3", "three")]


def test_one_large_file_is_read_by_many_tasks(spark, tmp_path, split_at):
    """No task sees more than its split, and the raw text is neither sorted nor shuffled."""
    record = json.dumps({"name": "n" * 300, "positive": 1, "tags": {"a": 1}})
    with open(tmp_path / "big.json", "w") as f:
        f.write("{" + ", ".join(f'"{i}": {record}' for i in range(100_000)) + "}")
    split_at(4 << 20)
    spark.conf.set("spark.sql.files.minPartitionNum", 8)
    assert os.path.getsize(tmp_path / "big.json") > 30 << 20
    records = _object_records(spark, str(tmp_path))
    assert records.agg(F.count("*"), F.countDistinct("appid"), F.max(F.length("record"))).first()[:2] == (100_000, 100_000)
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "SortAggregate" not in plan
    entries = json_object.read_entries(spark, str(tmp_path))
    assert entries.select("block").distinct().count() >= 8


def test_tables_do_not_depend_on_splits_or_file_sizes(spark, tmp_path, split_at):
    """The first record of an appid settles its tags: that of a.json, though b.json is larger and may be packed first."""
    record = lambda votes: json.dumps({"name": "x", "positive": 1, "tags": {"A": votes, "B": votes}})
    filler = ", ".join(f'"{i}": {record(9)}' for i in range(100, 400))
    for layout in ("object", "ndjson"):
        folder = tmp_path / layout
        folder.mkdir()
        if layout == "object":
            (folder / "a.json").write_text(f'{{"7": {record(1)}, "7.5": {record(2)}}}')
            (folder / "b.json").write_text(f'{{{filler}, "7": {record(3)}}}')
        else:
            line = lambda i, v: record(v)[:-1] + f', "appid": "{i}"}}\n'
            (folder / "a.json").write_text(line("7", 1) + line("7.5", 2))
            (folder / "b.json").write_text("".join(line(i, 9) for i in range(100, 400)) + line("7", 3))
        found = set()
        for n_bytes in (4_000, 1 << 20):
            split_at(n_bytes)
            tables = pipeline.load(spark, str(folder), layout)
            found.add(tuple(sorted(tuple(r) for r in tables.game_tags.filter("appid = 7").collect())))
        assert found == {((7, 1, 1), (7, 2, 1))}

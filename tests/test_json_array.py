import json
import random

import pytest

from corpusloom.sources import json_array
from corpusloom.sources.json_array import effect, elements, json_elements, read_json_array, then

NASTY = ['}],[{', '"', '\\', '\\"', '{"a": [1, {"b": "}"}]}', "é ", "", "a,b", "\\\\\"}"]


def objects(seed, n=60):
    r = random.Random(seed)
    value = lambda d: r.choice([r.choice(NASTY), r.randint(0, 9), None, True, *([[value(d - 1) for _ in range(r.randint(0, 3))], {r.choice(NASTY) + "k": value(d - 1)}] if d else [])])
    return [{"id": i, "s": r.choice(NASTY) * r.randint(0, 5), "v": value(3)} for i in range(n)]


@pytest.mark.parametrize("seed", range(8))
def test_effects_compose_and_elements_are_whole(seed):
    r = random.Random(seed)
    rows = objects(seed)
    text = "[" + r.choice([",", " , ", ",\n"]).join(json.dumps(x, ensure_ascii=seed % 2 == 0) for x in rows) + "]\n"
    cuts = sorted({i + 1 for i, c in enumerate(text) if c == "}" and r.random() < 0.3})
    parts = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
    state, pieces = (False, 0, 0), []
    for p in parts:
        pieces += elements(iter([p]), state[0], state[1])
        either = [effect(p, x) for x in (False, True)]
        state = then(state, either[state[0]])
    assert state[:2] == (False, 0)
    got, held = [], ""
    for began, ended, t in pieces:
        assert bool(held) != began
        held += t
        if ended:
            got.append(json.loads(held))
            held = ""
    assert got == rows and not held


@pytest.mark.parametrize("bad", ["", "{}", "[{]", "[1]", '["a"]', "[[]]", '[{"a": 1}', '[{"a": 1}]]', '[{"a": 1}] x', '{"id": "a"}', "[{}, 5]", 'x[{"a": 1}]', '[{"a": "}]'])
def test_what_is_no_array_of_objects(spark, tmp_path, bad):
    (tmp_path / "a.json").write_text(bad)
    with pytest.raises(Exception):
        json_elements(spark, str(tmp_path / "a.json")).collect()


@pytest.fixture
def small_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, 300)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    yield
    spark.conf.set(key, before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("seed", [0, 1])
def test_many_tasks_read_one_array(spark, tmp_path, small_splits, seed):
    rows = objects(seed, 200) + [{"id": 900, "s": "long" * 2000, "v": {"k": ["}"] * 900}}, {"id": 901, "s": "after", "v": None}]
    path = tmp_path / "a.json"
    path.write_text(" [\n" + ",\n".join(json.dumps(x, ensure_ascii=bool(seed), indent=seed or None) for x in rows) + "\n] ")
    got = json_elements(spark, str(path)).orderBy("start", "k").collect()
    assert [json.loads(r.text) for r in got] == rows and len({r.start for r in got}) > 10
    schema = spark.createDataFrame([], "id long, s string").schema
    plain = spark.read.schema(schema).option("multiLine", True).json(str(path))
    split = read_json_array(spark, str(path), schema)
    assert split.rdd.getNumPartitions() > 10 and plain.rdd.getNumPartitions() == 1
    assert sorted(map(repr, split.select("id", "s").collect())) == sorted(map(repr, plain.collect()))


def test_empty_array(spark, tmp_path):
    (tmp_path / "a.json").write_text("[ ]\n")
    assert json_elements(spark, str(tmp_path / "a.json")).collect() == []
    assert json_array.effect('"a\\"{', False) == (True, 0, 0)


def test_splits_of_large_files_are_larger(spark, tmp_path):
    cores = spark.sparkContext.defaultParallelism
    for size, want in ((10, 64), (64 * 8 * cores, 64), (6_400 * 8 * cores, 6_400)):
        (tmp_path / "part").write_bytes(b" " * size)
        assert json_array.split_bytes(spark, str(tmp_path), 64) == want

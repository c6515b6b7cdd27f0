import json
import random

import pytest

from quizloom import schemas
from quizloom.operators.upsert import read_store
from quizloom.plans import seeding
from quizloom.sources import documents
from quizloom.sources.documents import read_taxonomies, read_taxonomy
from quizloom.sources.files import write_texts
from quizloom.sources.json_text import read_texts

yaml = pytest.importorskip("yaml")
folder_files = documents._folder_files


def taxonomy(domain, **categories):
    return {
        "domain": domain,
        "categories": {
            c: [dict(zip(("topic", "difficulty"), item)) for item in items]
            for c, items in categories.items()
        },
    }


def put(folder, name, document):
    folder.mkdir(exist_ok=True)
    text = document if isinstance(document, str) else None
    if text is None:
        dump = json.dumps if name.endswith(".json") else yaml.safe_dump
        text = dump(document)
    (folder / name).write_text(text, encoding="utf-8")


def leaf_rows(spark, store):
    rows = read_store(spark, store, schemas.STORED_LEAF).collect()
    return {r["leaf_id"]: r.asDict() for r in rows}


def test_leaf_ids(spark, tmp_path):
    put(tmp_path / "t", "a.yaml", taxonomy("D", **{"X Y": [("A § 1 – B – C", "H"), ("Plain (x)", "E")]}))
    docs = read_taxonomies(spark, str(tmp_path / "t"))
    ids = {r["leaf_id"] for r in seeding.flatten_leaves(docs).collect()}
    assert ids == {"D.XY.A1", "D.XY.Plain(x)"}
    single = read_taxonomy(spark, str(tmp_path / "t" / "a.yaml"))
    legacy = {r["leaf_id"] for r in seeding.flatten_leaves(single, legacy=True).collect()}
    assert legacy == {"D.X Y.A§1", "D.X Y.Plain(x)"}


def test_load_order_and_reload(spark, tmp_path):
    folder, store = tmp_path / "t", str(tmp_path / "store")
    put(folder, "b.yaml", taxonomy("D", C=[("One", "E"), ("One", "M")]))
    put(folder, "a.json", taxonomy("D", C=[("One – json wins", "H"), ("Two", "H")]))
    put(folder, "skipped.yml", taxonomy("D", C=[("Never read", "H")]))
    assert seeding.seed_taxonomies(spark, str(folder), store) == {"processed": 4}
    rows = leaf_rows(spark, store)
    assert set(rows) == {"D.C.One", "D.C.Two"}
    assert rows["D.C.One"]["topic"] == "One – json wins"

    put(tmp_path / "u", "c.json", taxonomy("D", C=[("Two – later", "E"), ("Three", "E")]))
    assert seeding.seed_taxonomies(spark, str(tmp_path / "u"), store) == {"processed": 2}
    rows = leaf_rows(spark, store)
    assert {k: r["difficulty"] for k, r in rows.items()} == {
        "D.C.One": "H",
        "D.C.Two": "E",
        "D.C.Three": "E",
    }
    leaves = seeding.read_leaves(spark, store).collect()
    assert {r["id"]: r["label"] for r in leaves}["D.C.Two"] == "Two – later"


def test_faulty_taxonomies_change_nothing(spark, tmp_path):
    store = str(tmp_path / "store")
    put(tmp_path / "t", "a.yaml", taxonomy("D", C=[("One", "E")]))
    seeding.seed_taxonomies(spark, str(tmp_path / "t"), store)
    put(tmp_path / "u", "a.json", taxonomy("D", C=[("Two", "E"), ("Three",)]))
    with pytest.raises(ValueError, match="topic or difficulty"):
        seeding.seed_taxonomies(spark, str(tmp_path / "u"), store)
    put(tmp_path / "v", "a.json", "{broken")
    with pytest.raises(ValueError, match="unreadable"):
        seeding.seed_taxonomies(spark, str(tmp_path / "v"), store)
    assert set(leaf_rows(spark, store)) == {"D.C.One"}


def test_incomplete_version_is_not_read(spark, tmp_path):
    store = tmp_path / "store"
    put(tmp_path / "t", "a.yaml", taxonomy("D", C=[("One", "E")]))
    seeding.seed_taxonomies(spark, str(tmp_path / "t"), str(store))
    (store / "version=2").mkdir()
    assert set(leaf_rows(spark, str(store))) == {"D.C.One"}
    seeding.seed_taxonomies(spark, str(tmp_path / "t"), str(store))
    assert (store / "version=3" / "_SUCCESS").exists()


def prompt(prompt_id, **fields):
    return {"prompt_id": prompt_id, **fields}


def test_prompt_store(spark, tmp_path):
    folder, store = tmp_path / "p", str(tmp_path / "store")
    put(folder, "a.json", prompt("one", template="T1", parser_regex=r"Q\d+", version=1.0))
    put(folder, "b.yaml", prompt("two", template="T2", description="kept"))
    put(folder, "c.json", {"template": "no id"})
    put(folder, "d.json", "{broken")
    put(folder, "e.json", prompt("three", parser_regex="(a)(b)"))
    put(folder, "f.json", prompt("four", parser_regex="(unclosed"))
    first = seeding.seed_prompts(spark, str(folder), store)
    assert first == {"upserted": 4, "modified": 0, "skipped": 2}
    assert seeding.seed_prompts(spark, str(folder), store)["modified"] == 0

    put(tmp_path / "q", "z.json", prompt("two", template="T2b", version="v2", owner="me", tags=[1]))
    again = seeding.seed_prompts(spark, str(tmp_path / "q"), store)
    assert again == {"upserted": 0, "modified": 1, "skipped": 0}
    two = seeding.get_prompt(spark, store, "two").first()
    assert (two["template"], two["description"], two["version"]) == ("T2b", "kept", "v2")
    assert two["extra"] == {"owner": "me", "tags": "[1]"}
    put(tmp_path / "r", "z.json", prompt("two", owner="you"))
    again = seeding.seed_prompts(spark, str(tmp_path / "r"), store)
    assert again == {"upserted": 0, "modified": 1, "skipped": 0}
    two = seeding.get_prompt(spark, store, "two").first()
    assert two["extra"] == {"owner": "you", "tags": "[1]"}
    with pytest.raises(ValueError, match="missing"):
        seeding.get_prompt(spark, store, "missing")


def test_hot_leaf_id(spark):
    """One id with a third of all rows: its last row wins, whatever the partitioning."""
    rows = [("D", "C", f"t{i}", "H", "hot" if i % 3 == 0 else f"k{i}", i) for i in range(600)]
    incoming = spark.createDataFrame(
        rows, "domain STRING, category STRING, topic STRING, difficulty STRING, leaf_id STRING, load_order INT"
    )
    stored = spark.createDataFrame([("D", "C", "old", "E", "hot"), ("D", "C", "o", "E", "only")], schemas.STORED_LEAF)
    for parts in (1, 4, 16):
        merged = seeding.upsert_leaves(stored, incoming.repartition(parts)).collect()
        topics = {r["leaf_id"]: r["topic"] for r in merged}
        assert len(merged) == len(topics) == 402
        assert (topics["hot"], topics["only"]) == ("t597", "o")


def test_rejects_are_named(spark, tmp_path):
    folder, store, rejects = tmp_path / "p", str(tmp_path / "store"), str(tmp_path / "rejects")
    put(folder, "a.json", prompt("one", template="T1"))
    put(folder, "b.json", "{\n  \"prompt_id\": oops}")
    put(folder, "c.yaml", "prompt_id: x\ntemplate: [1, 2")
    put(folder, "d.json", {"template": "no id"})
    put(folder, "e.yaml", "just words")
    put(folder, "f.json", "[1, 2]")
    put(folder, "g.json", "")
    put(folder, "h.yaml", "a: b: c")
    counts = seeding.seed_prompts(spark, str(folder), store, rejects)
    assert counts == {"upserted": 1, "modified": 0, "skipped": 7}
    found = {r.path.rsplit("/", 1)[1]: (r.place, r.reason) for r in spark.read.parquet(rejects).collect()}
    assert found == {
        "b.json": ("2:16", "Expecting value"),
        "c.yaml": ("2:16", "expected ',' or ']', but got '<stream end>'"),
        "d.json": (None, "no prompt_id"),
        "e.yaml": (None, documents.NOT_A_DOCUMENT),
        "f.json": (None, documents.NOT_A_DOCUMENT),
        "g.json": ("1:1", "Expecting value"),
        "h.yaml": ("1:5", "mapping values are not allowed here"),
    }


@pytest.mark.parametrize(
    "name, text, reason",
    [
        ("t.json", '{"domain": "D"}', "no categories"),
        ("t.yaml", "categories: {}", "no domain"),
        ("t.json", '{"domain"', "1:10 Expecting ':' delimiter"),
    ],
)
def test_faulty_taxonomy_is_named_with_its_reason(spark, tmp_path, name, text, reason):
    put(tmp_path / "t", name, text)
    with pytest.raises(ValueError, match=f"{name}: {reason}"):
        seeding.seed_taxonomies(spark, str(tmp_path / "t"), str(tmp_path / "store"))


def test_files_written_by_tasks(spark, tmp_path):
    folder = str(tmp_path / "files")
    rows = [(f"{i}.txt", None if i == 3 else f"text é\n{i}") for i in range(20)]
    df = spark.createDataFrame(rows, "name STRING, text STRING").repartition(3)
    for _ in range(2):
        assert write_texts(df, folder) == 20
    names = sorted(p.name for p in (tmp_path / "files").iterdir())
    assert names == sorted(name for name, _ in rows)
    assert all((tmp_path / "files" / name).read_text() == (text or "") for name, text in rows)


def test_many_small_files_are_read_in_few_tasks(spark, tmp_path):
    """The number of tasks is bounded however many files a folder has; none is lost."""
    for i in range(1300):
        put(tmp_path / "t", f"{i}.json", f'{{"prompt_id": "p{i}", "template": "t"}}')
    put(tmp_path / "t", "void.yaml", "")
    read = documents.read_prompts(spark, str(tmp_path / "t"))
    assert read.rdd.getNumPartitions() <= 8 * spark.sparkContext.defaultParallelism + 5
    rows = read.collect()
    assert {r["doc"]["prompt_id"] for r in rows if r["problem"] is None} == {f"p{i}" for i in range(1300)}
    bad = [r["path"].rsplit("/", 1)[1] for r in rows if r["problem"] is not None]
    assert bad == ["void.yaml"]


def test_files_are_written_by_several_tasks(spark, tmp_path):
    """Also rows that lie in one partition."""
    rows = spark.range(2000).coalesce(1).selectExpr("cast(id as string) name", "'x' text")
    folder = str(tmp_path / "out")
    group = "several-writers"
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert write_texts(rows, folder) == 2000
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(list((tmp_path / "out").iterdir())) == 2000
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s) > 1


def test_a_folder_is_listed_without_a_call_for_each_file(spark, tmp_path, monkeypatch):
    """Calls from Python to the JVM do not grow with the files; empty ones are still found."""
    client = spark._jvm._gateway_client
    send, calls = client.send_command, []
    monkeypatch.setattr(client, "send_command", lambda *a, **k: calls.append(1) or send(*a, **k))
    needed = []
    for count in (20, 420):
        folder = tmp_path / f"t{count}"
        for i in range(count):
            put(folder, f"{i}.json", f'{{"prompt_id": "p{i}"}}')
        for name in ("void.json", "void.yaml", "_void.yaml", "void.txt"):
            put(folder, name, "")
        calls.clear()
        read = documents.read_prompts(spark, str(folder))
        needed.append(len(calls))
        bad = [r["path"] for r in read.filter("problem IS NOT NULL").collect()]
        assert sorted(bad) == [f"file:{folder}/void.json", f"file:{folder}/void.yaml"]
    assert needed[1] < needed[0] + 100


def test_yaml_is_read_as_by_its_own_parser(spark, tmp_path):
    """Also texts that libyaml takes and PyYAML does not, or takes otherwise."""
    alike = ["a: 'b''s'\nc:\n- 1.50\n- {d: yes, e: [~, 0x1F]}\n", '{"a": "\\u00e9 \\n", "b": 012}', "é: – § x # y"]
    alike += ["", "a: 2001-01-01", "<<: {a: 1}\nb: 2", "---\na: 1e3\n", "a: b\n c\n\n d\n"]
    apart = ["a: [b?c]", "a: |#\n  x", "a: !", "a:\tb", "a: b\r\nc: d", "- " * 60 + "x", "[" * 60 + "]" * 60]
    assert all(documents._is_simple(text) for text in alike)
    assert not any(documents._is_simple(text) for text in apart)
    rows = spark.createDataFrame(list(enumerate(alike + apart + ["a: b: c", "a: [1"])), "i INT, text STRING")
    found = rows.select("text", documents._yaml_to_json("text").alias("y")).select("text", "y.*").collect()
    for row in found:
        try:
            value = yaml.safe_load(row["text"])
        except yaml.MarkedYAMLError as error:
            mark = error.problem_mark
            assert (row[1], row[2], row[3]) == (None, f"{mark.line + 1}:{mark.column + 1}", error.problem)
        else:
            assert (row[1], row[3]) == (json.dumps(value, ensure_ascii=False, default=str), None)


def test_the_quick_parser_agrees_on_random_texts():
    r = random.Random(7)
    parts = [*"ab 1:-,'\"[]{}#\\\n\n  `.~=/<é–", "\n  ", "\n- ", ": ", "- ", " #", "''", "---", "<<: ", "{a: b}", "\\x41"]
    read = 0
    for _ in range(6000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(1, 12)))
        if documents._is_simple(text):
            try:
                quick = yaml.load(text, yaml.CSafeLoader)
            except (yaml.YAMLError, ValueError):
                continue
            assert repr(quick) == repr(yaml.safe_load(text)), text
            read += 1
    assert read > 1000


def test_small_files_are_read_as_bytes_and_give_the_same_texts(spark, tmp_path, monkeypatch):
    odd = [b"\xef\xbb\xbf{}", b"a\r\nb\rc\n", b"\xff\xfe bad \xc3", "ü\u2028😀\x00z".encode(), b" ", b"\x1f\x8b\x08"]
    for i, content in enumerate(odd):
        (tmp_path / f"{i}.{'json' if i % 2 else 'yaml'}").write_bytes(content)
    pattern, seen = "*.{json,yaml}", []
    monkeypatch.setattr(documents, "_folder_files", lambda listed, *a: seen.append(listed) or folder_files(listed, *a))
    documents.read_prompts(spark, str(tmp_path))
    whole = read_texts(spark, str(tmp_path), pattern, file_per_row=True)
    columns = ["path", "name", "hex(text) AS bytes"]
    assert sorted(seen[0].selectExpr(*columns).collect()) == sorted(whole.selectExpr(*columns).collect())
    assert seen[0].count() == len(odd)
    assert "binaryFile" in seen[0]._jdf.queryExecution().toString()

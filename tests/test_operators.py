"""Operators on small literal inputs with values worked out by hand."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from curatrix.functions import text as T
from curatrix.functions import values
from curatrix.operators import compare, coverage, curation, export, filters, graph, models, scoring, tools
from curatrix.plans import fixtures, pipelines
from curatrix.sources import config, readers, sinks, tool_parsers

PAIRS = [
    ("What is HDF5?", "HDF5 is a data model for large scientific files."),
    ("How does HDF5 chunking improve the speed of reading parts of large arrays?", "- " + " ".join(["word"] * 48)),
    ("Compare B-tree and extensible array indexes here.", " ".join(["word"] * 18)),
]


@pytest.fixture(scope="module")
def pairs(spark):
    return spark.createDataFrame([(i, q, a) for i, (q, a) in enumerate(PAIRS)], "idx long, question string, answer string")


@pytest.fixture(scope="module")
def net(spark):
    nodes, params = fixtures.nodes(spark), fixtures.params(spark)
    return nodes, graph.edges(nodes, params)


def test_heuristic_scores(pairs):
    rows = scoring.score(pairs).orderBy("idx").collect()
    assert [(r.complexity, r.quality) for r in rows] == [(4, 4), (6, 8), (6, 6)]
    assert [round(r.combined, 6) for r in rows] == [4.2, 6.8, 5.8]


@pytest.mark.parametrize("n, score", [(9, 4), (10, 6), (29, 6), (30, 7)])
def test_quality_boundaries(spark, n, score):
    assert spark.range(1).select(T.quality(F.lit("a b"), F.lit(" ".join(["w"] * n)))).first()[0] == score


@pytest.mark.parametrize("n, score", [(20, 4), (21, 5)])
def test_complexity_boundaries(spark, n, score):
    assert spark.range(1).select(T.complexity(F.lit(" ".join(["w"] * n)))).first()[0] == score


@pytest.mark.parametrize("target, chunks, n", [(100, 20, 5), (10, 20, 1), (5, 2, 2), (7, 2, 4)])
def test_pairs_per_chunk(spark, target, chunks, n):
    assert spark.range(1).select(T.pairs_per_chunk(F.lit(target), F.lit(chunks))).first()[0] == n


def test_graph_numbers(net):
    nodes, edge = net
    s = graph.statistics(nodes, edge).first()
    assert (s.n_nodes, s.n_entry_points, s.n_categories) == (5, 3, 3)
    lists = {r.tool_id: r.next for r in graph.export(nodes, edge).collect()}
    assert lists["close_file"] == []
    assert s.n_edges == edge.count() and s.max_out_degree == max(map(len, lists.values()))
    found = [r.chain for r in graph.chains(edge, nodes.where("tool_id = 'open_file'").select("tool_id")).collect()]
    assert all(len(set(c)) == len(c) and 2 <= len(c) <= 4 for c in found)
    assert all(b in lists[a] for c in found for a, b in zip(c, c[1:], strict=False))


@pytest.mark.parametrize("o, w, score", [("string", "string", 1.0), ("string", "any", 0.8), ("integer", "number", 0.6), ("string", "integer", 0.0), ("any", "string", 0.6), ("String", "STRING", 1.0), ("odd", "odd", 1.0)])
def test_type_scores(spark, o, w, score):
    assert spark.range(1).select(graph.type_score(F.lit(o), F.lit(w))).first()[0] == score


def test_histogram_leaves_zero_out(spark):
    df = spark.createDataFrame([(0.0,), (7.0,), (7.5,), (10.0,)], "rating double")
    assert {r.bucket: r.n for r in curation.histogram(df).collect() if r.n} == {7: 2, 10: 1}


@pytest.mark.parametrize("score, executed, missing, strict, want", [
    (0.9, True, [], False, ("fully_satisfied", 0.9)), (0.5, True, [], False, ("partially_satisfied", 0.5)), (0.49, True, [], False, ("not_satisfied", 0.49)),
    (0.95, True, ["x"], True, ("not_satisfied", 0.5)), (0.95, False, [], False, ("execution_failed", 0.0)), (None, True, [], False, ("cannot_evaluate", 0.5)),
])
def test_outcomes(spark, score, executed, missing, strict, want):
    df = spark.createDataFrame([(score, executed, missing)], "s double, e boolean, m array<string>")
    assert tuple(df.select(tools.outcome("s", "e", "m", strict).alias("o")).first().o) == want


@pytest.mark.parametrize("counts, n, want", [((5, 3, 2), 4, [2, 1, 1]), ((97, 1, 1, 1), 3, [2, 1, 1, 1])])
def test_quotas(spark, counts, n, want):
    df = spark.createDataFrame([(c,) for c, k in enumerate(counts) for _ in range(k)], "label int")
    assert [r.quota for r in coverage.quotas(df, n).orderBy("label").collect()] == want


def test_centroid_selection_is_cut(spark):
    rows = [(i, [float(i)], 0) for i in range(97)] + [(97 + k, [0.0], k + 1) for k in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert sorted(r.label for r in coverage.select_centroid(df, 3).collect()) == [0, 0, 1]


def test_full_coverage_is_one(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert coverage.coverage_score(df, df).first()[0] == pytest.approx(1.0)
    assert coverage.coverage_score(df, df.limit(0)).first()[0] == 0.0


def test_farthest_first_is_distinct(spark):
    df = spark.createDataFrame([(i, [float(i % 7), float(i)], i % 3) for i in range(30)], "vec_id long, embedding array<float>, label int")
    got = [r.vec_id for r in coverage.select_diverse(df, 10).collect()]
    assert len(got) == len(set(got)) == 10


def test_farthest_first_considers_all_rows(spark):
    rng = np.random.default_rng(9)
    labels = rng.integers(0, 3, 400)
    labels[7] = 5
    v = rng.integers(0, 6, (400, 3)).astype(float)
    least, left, want = np.full(400, np.inf), np.ones(400, bool), []
    while len(want) < 90:
        for c in np.unique(labels):
            some = np.flatnonzero(left & (labels == c))
            if len(want) < 90 and len(some):
                i = int(some[np.argmax(least[some])])
                want.append(i)
                left[i], least = False, np.minimum(least, np.linalg.norm(v - v[i], axis=1))
    df = spark.createDataFrame([(i, v[i].tolist(), int(labels[i])) for i in range(400)], "vec_id long, embedding array<float>, label int").repartition(3)
    for candidates in (20_000, 80):
        assert [r.vec_id for r in coverage.select_diverse(df, 90, candidates=candidates).orderBy("pick").collect()] == want
    assert coverage.select_diverse(df.limit(0), 5).count() == 0


def test_kmeans_query_takes_its_cluster_count_from_the_target(spark):
    from curatrix.plans import registry

    got = registry.QUERIES["kmeans_select"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len({r.vec_id for r in got}) == 60
    assert {r.cluster for r in got} == set(range(coverage.cluster_count(60)))


def test_lenient_json(spark):
    raws = ['[{"question": "q", "answer": "a"}]', 'Text [{"question": "q", "answer": "a"},] more', "[{'question': 'q', 'answer': 'a'}]", "[{question: \"q\", answer: \"a\",}]", "not JSON", "", None]
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    got = [r.p for r in df.select(T.parse_json("raw", "array<struct<question:string,answer:string>>").alias("p")).collect()]
    assert [bool(g) and (g[0].question, g[0].answer) == ("q", "a") for g in got] == [True] * 4 + [False] * 3


def test_fences_and_brackets(spark):
    df = spark.createDataFrame([("```json\n[1]\n```",), ("```\n[1]\n``` done",), (" [1] ",), ("see ```x```",)], "raw string")
    assert [r[0] for r in df.select(T.strip_fence("raw")).collect()] == ["[1]", "[1]", "[1]", "see ```x```"]
    assert T.matching_array('x ["a]", [1]] y]') == '["a]", [1]]'
    assert T.matching_array("[1") is None and T.matching_array(None) is None
    assert json.loads(T.parse_conversations('```json\n[[{"role": "user",},],]\n```')) == [[{"role": "user"}]]
    assert T.parse_conversations("nothing") is None
    udf = T.parse_conversations_udf()
    assert spark.createDataFrame([("[1,]",), (None,)], "raw string").select(udf("raw")).collect()[0][0] == "[1]"


def test_reasoning(spark):
    texts = ["Step 1: look.\nTherefore, it is so.", "No marks here.", "First, this only."]
    rows = spark.createDataFrame([(t,) for t in texts], "c string").select(T.split_reasoning("c").alias("r")).collect()
    assert [tuple(r.r) for r in rows] == [("Step 1: look.", "it is so."), ("", texts[1]), (texts[2], texts[2])]


def test_filters(spark):
    df = spark.createDataFrame([("a", "x" * 200, "docs/a.md"), ("b", " " * 300, "docs/b.md"), ("c", "y" * 300, "x/login.md"), ("d", None, None)], "id string, content string, source_file string")
    assert [r.id for r in filters.skip_sources(filters.min_content(df)).collect()] == ["a"]
    assert [r.id for r in filters.not_blank(df).orderBy("id").collect()] == ["a", "c"]
    steps = "struct<success:boolean,step_results:array<struct<success:boolean>>>"
    ex = spark.createDataFrame([(1, (True, [(True,), (False,)])), (2, None), (3, (False, []))], f"idx int, execution_result {steps}")
    assert [r.idx for r in filters.executed(ex, 0.5).collect()] == [1]
    assert [r.idx for r in filters.executed(ex, 1.0).collect()] == [1]
    assert filters.executed(ex, 0).count() == 3


def test_conversation_round_trip(pairs):
    there = curation.to_conversation(pairs)
    back = curation.from_conversation(there.select("idx", "conversations"))
    assert sorted((r.idx, r.question, r.answer) for r in back.collect()) == sorted(map(tuple, pairs.collect()))
    assert curation.detect_format(there) == "conversation" and curation.detect_format(pairs) == "qa"


def test_exports(spark, pairs):
    for kind in export.FORMATS:
        assert len(export.as_lines(export.to_format(pairs, kind)).collect()) == 3
    with pytest.raises(ValueError):
        export.to_format(pairs, "xml")
    path = "array<struct<step:int,thought:string,tool:string,args:map<string,string>,actual_result:string,status:string,error_message:string>>"
    ex = spark.createDataFrame([(1, "do it now please", [(1, "think", "calculator", {"expression": "2+2"}, "4", "success", None)], "4")], f"example_id int, instruction string, reasoning_path {path}, final_answer string")
    text = export.to_format(ex, "alpaca").first().record.output
    assert text == "Step 1: think\nTool: calculator(expression='2+2')\n\n4"
    assert len(export.example_to_chatml(ex).first().messages) == 4
    assert export.example_to_alpaca(ex).count() == export.example_to_sharegpt(ex).count() == export.call_chat(ex).count() == 1
    done = tools.run_steps(ex).first()
    assert done.success and done.output.toPython() == 4
    assert ex.select(filters.format_errors()).first()[0] == []
    assert "calculator" in ex.select(tools.solution_summary()).first()[0]


@pytest.mark.parametrize("text, value", [("2+2", 4), ("3*3", 9), ("-(1+2)/2", -1.5)])
def test_calculator(text, value):
    assert tools.calculate(text) == value


def test_calculator_refuses_names():
    with pytest.raises(ValueError):
        tools.calculate("__import__('os')")


def test_tool_parsers(spark):
    spec = {"paths": {"/a/{id}": {"get": {"operationId": "getA", "summary": "Gets", "parameters": [{"$ref": "#/components/parameters/Id"}]}}}, "components": {"parameters": {"Id": {"name": "id", "required": True, "schema": {"type": "integer"}}}}}
    assert tool_parsers.openapi(spec)[0]["parameters"] == [{"name": "id", "type": "integer", "description": "", "required": True, "default": None, "enum": None}]
    module = 'def f(a: int, b: str = "x") -> float:\n    """Does.\n\n    Args:\n        a: first\n            goes on\n        b: second\n\n    Returns:\n        A number.\n    """\n\ndef _g():\n    pass\n'
    found = tool_parsers.python_module(module)
    assert len(found) == 1 and found[0]["parameters"][0] == {"name": "a", "type": "integer", "description": "first goes on", "required": True, "default": None, "enum": None}
    assert found[0]["returns"] == {"type": "number", "description": "A number."}
    assert tool_parsers.json_tools({"name": "My Tool", "parameters": {"properties": {"x": {"type": "string"}}, "required": ["x"]}})[0]["tool_id"] == "my_tool"
    assert tools.invalid_tools(tool_parsers.frame(spark, found)).count() == 0
    assert tool_parsers.function(tools.calculate)["name"] == "calculate"


def test_readers_and_sinks(spark, tmp_path, pairs):
    (tmp_path / "one.json").write_text(json.dumps([{"question": q, "answer": a, "rating": 8 - i} for i, (q, a) in enumerate(PAIRS)]))
    (tmp_path / "tools.json").write_text(json.dumps({"tools": [{"name": "T One", "description": "d", "parameters": []}]}))
    (tmp_path / "bad.json").write_text('{"other": 1}')
    df = readers.datasets(spark, [str(tmp_path / "one.json")], "question string, answer string, rating double, source string")
    assert [(r.idx, r.dataset) for r in df.orderBy("idx").collect()] == [(0, "one"), (1, "one"), (2, "one")]
    assert compare.dataset_metrics(df).first().avg_rating == 7.0
    assert readers.tools(spark, str(tmp_path / "tools.json")).first().tool_id == "t_one"
    with pytest.raises(ValueError):
        readers.tools(spark, str(tmp_path / "bad.json"))
    sinks.result_bundle(pairs, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/parquet")).count() == 3
    rated = pairs.withColumns({"rating": F.lit(7.5), "topic_relevant": F.lit(True)})
    sinks.curation_bundle(rated, 7.0, str(tmp_path / "cur"))
    assert spark.read.json(str(tmp_path / "cur/metrics")).first().filtered == 3


def test_config(tmp_path):
    assert config.resolve({"provider": "gemini", "google": {"model": "m", "temperature": 0}}).temperature == 0
    with pytest.raises(ValueError):
        config.resolve({"provider": "unheard"})
    with pytest.raises(FileNotFoundError):
        config.prompts(str(tmp_path / "none"))
    (tmp_path / "p.json").write_text('{"prompt": "hello"}')
    assert config.prompts(str(tmp_path)) == {"p": "hello"}


def test_pipelines_with_stub(spark):
    chunks = spark.createDataFrame([(str(i), f"file{i}.md", f"text number {i} " * 20) for i in range(12)], "chunk_id string, source_file string, content string")
    assert pipelines.qa_pipeline(chunks, threshold=0.0).count() <= 12
    listed = tool_parsers.frame(spark, tool_parsers.json_tools([{"name": f"t{i}", "description": "d"} for i in range(4)]))
    assert pipelines.tool_pipeline(listed, 1, 0.0).count() == 4


def test_models_fall_back(spark, pairs):
    class Silent:
        def generate(self, prompt, temperature=None, max_tokens=None):
            return "no JSON"

    models.register_provider("silent", lambda **_: Silent())
    rated = models.rate_pairs(pairs, "{question}", provider="stub")
    assert rated.count() == 3
    assert models.ask_with_retries(Silent(), "x") == "no JSON"

    class Busy:
        calls = 0

        def generate(self, prompt, temperature=None, max_tokens=None):
            Busy.calls += 1
            raise models.RateLimited("wait")

    with pytest.raises(models.RateLimited):
        models.ask_with_retries(Busy(), "x", wait=0)
    assert Busy.calls == 3


def test_embedding_once_per_text(spark, pairs):
    rows = coverage.embedding_text(pairs.union(pairs))
    assert coverage.embed(rows, lambda: lambda texts: [[len(t), 1.0] for t in texts]).where("embedding[1] = 1").count() == 6
    bare = spark.createDataFrame([(1, "x")], "n int, other string")
    assert coverage.embedding_text(bare).first().embedding_text == '{"n":1,"other":"x"}'


def test_model_operators_on_examples(spark):
    class Solver:
        def generate(self, prompt, temperature=None, max_tokens=None):
            if prompt.startswith("solve"):
                return 'Here: {"reasoning_path": [{"step": 1, "thought": "t", "tool": "string_length", "args": {"text": "abc"}}], "final_answer": "3"}'
            return '{"valid": false} ["needs a number"]' if prompt.startswith("check") else '[{"question": "ask"}]'

    models.register_provider("solver", lambda **_: Solver())
    df = spark.createDataFrame([(1, "how long is abc")], "example_id long, instruction string")
    solved = models.annotate(df, "solve {instruction}", provider="solver")
    assert solved.first().final_answer == "3" and tools.run_steps(solved).first().output.toPython() == 3
    assert models.simulate_steps(solved, "run {tool} {args}", provider="solver").first().success
    assert models.verify(solved, "check {answer}", provider="solver").first().verified is False
    assert models.requirements(df, "check {instruction}", provider="solver").first().requirement == "needs a number"
    net = spark.createDataFrame([(["a", "b", "c"],), (["a"],)], "chain array<string>")
    assert [r.difficulty for r in models.chain_first(net, "{chain}", 2, provider="solver").collect()] == ["complex"]


def test_stream_resumes(spark, tmp_path):
    from curatrix.streaming.resume import process_new_chunks

    src, out, mark = (str(tmp_path / n) for n in ("src", "out", "mark"))
    spark.range(5).write.parquet(src)
    run = lambda: process_new_chunks(spark, src, "id long", lambda d: d.where("id >= 0"), out, mark).awaitTermination()
    run()
    spark.range(5, 8).write.mode("append").parquet(src)
    run()
    run()
    assert spark.read.parquet(out).count() == 8


def test_cli_has_all_commands():
    from curatrix import cli

    assert len(cli.COMMANDS) == 22
    assert cli.parser().parse_args(["tool-deps", "x.json", "--validate", "a -> b"]).validate == "a -> b"


def test_row_order_does_not_matter(spark, pairs):
    a = scoring.top_k(scoring.score(pairs), 2).collect()
    b = scoring.top_k(scoring.score(pairs.repartition(3)), 2).collect()
    assert a == b
    assert scoring.seeded_sample(pairs, 2, "idx").collect() == scoring.seeded_sample(pairs.repartition(3), 2, "idx").collect()


def test_first_of_each_with_null_and_repeated_orders(spark):
    rows = [(1, "A "), (1, "a"), (2, "a"), (None, "b"), (None, "b"), (None, " B"), (3, None), (4, ""), (4, ""), (5, "c")]
    got = scoring.first_of_each(spark.createDataFrame(rows, "idx int, content string"), "content", "idx").collect()
    assert sorted((str(r.content or "").strip().lower(), r.idx) for r in got) == [("", 3), ("a", 1), ("b", None), ("c", 5)]
    assert scoring.first_of_each(spark.createDataFrame([], "idx int, content string"), "content", "idx").count() == 0


@pytest.mark.parametrize("text, written", [("a", "'a'"), ("it's", '"it\'s"'), ("it's \"x\"", "'it\\'s \"x\"'"), ("a\nb\\", "'a\\nb\\\\'"), (None, "None")])
def test_arguments_are_written_as_python_does(spark, text, written):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(values.quoted(F.col("t")), values.written(F.col("t"))).first()[:] == (written, written) == (repr(text), repr(text))


def test_large_powers_are_refused():
    for text in ("9**9**9", "2**5000", "(10**1000)*(10**1000)"):
        with pytest.raises(ValueError):
            tools.calculate(text)
    assert tools.calculate("2**64") == 2**64


def test_raw_answers_are_asked_for_once(spark, tmp_path):
    asked = []
    models.register_provider("once", lambda **_: type("Once", (), {"generate": lambda self, prompt, **_: open(f"{tmp_path}/calls", "a").write("x") and '[{"rating": 9}]'})())
    df = models.rate_pairs(spark.createDataFrame([(1, "q", "a"), (2, "r", "b")], "idx int, question string, answer string"), "{question}", provider="once", raw_path=f"{tmp_path}/raw")
    asked += [df.collect(), df.collect()]
    assert asked[0] == asked[1] and [r.rating for r in asked[0]] == [9.0, 9.0]
    assert len(open(f"{tmp_path}/calls").read()) == 2


def test_scratch_folder_is_shared_or_refused(spark):
    from types import SimpleNamespace

    from curatrix.sources.scratch import scratch_dir

    conf = SimpleNamespace(get=lambda k, d=None: d)
    with pytest.raises(ValueError):
        scratch_dir(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077")), "x")
    assert scratch_dir(spark, "a") != scratch_dir(spark, "a")


def _serve(answers):
    """A local server that records what it is asked and gives the answers in turn."""
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    seen = []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):  # noqa: N802
            body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
            seen.append((self.path, {k.lower(): v for k, v in self.headers.items()}, body))
            code, answer = answers[min(len(seen), len(answers)) - 1]
            raw = json.dumps(answer).encode()
            self.send_response(code)
            self.send_header("Content-Length", str(len(raw)))
            self.end_headers()
            self.wfile.write(raw)

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server, f"http://127.0.0.1:{server.server_port}", seen


@pytest.mark.parametrize("provider, answer, header, place", [
    ("openai", {"choices": [{"message": {"content": "hi"}}]}, ("authorization", "Bearer k"), ("max_tokens",)),
    ("anthropic", {"content": [{"type": "text", "text": "h"}, {"type": "text", "text": "i"}]}, ("x-api-key", "k"), ("max_tokens",)),
    ("google", {"candidates": [{"content": {"parts": [{"text": "hi"}]}}]}, ("x-goog-api-key", "k"), ("generationConfig", "maxOutputTokens")),
])
def test_protocols_of_model_servers(provider, answer, header, place):
    server, url, seen = _serve([(429, {}), (200, answer), (500, {})])
    try:
        client = models.client(provider, model="m", url=url + "/{model}" if provider == "google" else url, key="k", max_tokens=99)
        assert models.ask_with_retries(client, "prompt", wait=0) == "hi"
        assert len(seen) == 2 and seen[1][1][header[0]] == header[1] and "prompt" in json.dumps(seen[1][2])
        found = seen[1][2]
        for key in place:
            found = found[key]
        assert found == 99 and (provider != "google" or seen[1][0] == "/m")
        with pytest.raises(Exception):
            models.ask_with_retries(client, "prompt", wait=0)
        assert len(seen) == 3
    finally:
        server.shutdown()


def test_execution_modes(spark):
    from curatrix.operators import execution

    listed = tool_parsers.frame(spark, tool_parsers.json_tools([{"name": "adder", "description": "adds", "parameters": [{"name": "x", "required": True}], "returns": {"type": "integer"}}, {"name": "echoer", "description": "e"}]))
    step = lambda n, tool, **args: (n, "t", tool, args)
    rows = [(1, "a", [step(1, "adder", x="1"), step(2, "echoer")]), (2, "b", [step(1, "adder")]), (3, "c", [step(1, "nothing"), step(2, "adder", x="2")]), (4, "d", []), (5, "e", None)]
    df = spark.createDataFrame(rows, "example_id int, instruction string, reasoning_path array<struct<step:int,thought:string,tool:string,args:map<string,string>>>")
    real = {r.example_id: r for r in execution.execute_examples(df, listed, "real", implementations={"adder": lambda x: int(x) + 1}).collect()}
    assert [s.status for s in real[1].reasoning_path] == ["success", "failure"] and real[1].reasoning_path[0].actual_result.toPython() == 2 and not real[1].execution_result.success
    assert real[2].execution_result.error == "Missing required parameter: x" and real[3].execution_result.error == "Unknown tool: nothing"
    assert real[3].reasoning_path[1].actual_result.toPython() == 3 and not real[4].execution_result.success and not real[5].execution_result.success
    told = {r.example_id: r for r in execution.execute_examples(df, listed, "simulated", "{tool_name} {args_json} {context}", provider="echo").collect()}
    assert told[1].execution_result.success and told[1].reasoning_path[0].actual_result.toPython() == 'adder {"x": "1"}' and "last_result" in told[1].reasoning_path[1].actual_result.toPython()
    with pytest.raises(ValueError):
        execution.execute_examples(df, listed, "other")
    assert execution.execute_examples(df.limit(0), listed, "simulated", provider="echo").count() == 0


def test_templates_hold_the_named_fields():
    import re

    from curatrix.sources.templates import TEMPLATES

    assert len(TEMPLATES) == 8 + 14
    fields = {k: set(re.findall(r"\{(\w+)\}", v)) for k, v in TEMPLATES.items()}
    assert fields["tool_simulation"] == {"tool_name", "tool_description", "return_type", "args_json", "context"}
    assert fields["qa_generation"] == {"n_pairs_min", "n_pairs_max", "text"} and fields["chain_generation"] == {"min_steps", "max_steps", "tools_json"}


def test_decision_falls_back_to_the_best_score(spark):
    judged = spark.createDataFrame([("a", 3.0, "{}", False), ("b", 8.0, "{}", True)], "dataset string, score double, metrics string, wins boolean")
    assert models.decide(judged, "WINNER: a", provider="echo") == "a"
    assert models.decide(judged, "WINNER: neither", provider="echo") == "b" == models.decide(judged, "nothing", provider="echo")


def test_commands_end_to_end(spark, tmp_path, monkeypatch):
    from curatrix import cli

    monkeypatch.setattr(cli, "_session", lambda: spark)
    pairs = [{"question": f"How does part {k} work and why?", "answer": f"Part {k} turns. " * 8, "source": "s"} for k in range(6)]
    (tmp_path / "a.json").write_text(json.dumps(pairs[:4]))
    (tmp_path / "b.json").write_text(json.dumps(pairs[4:]))
    (tmp_path / "tools.json").write_text(json.dumps({"tools": [{"name": f"tool{k}", "description": f"does {k}", "parameters": [], "returns": {"type": "string"}} for k in range(3)]}))
    (tmp_path / "conf.json").write_text(json.dumps({"llm": {"provider": "stub", "temperature": 0.1}}))
    out = lambda name: str(tmp_path / name)
    cli.main(["compare", out("a.json"), out("b.json"), "--output", out("compare"), "--judge", "--config", out("conf.json")])
    assert json.loads(spark.read.text(out("compare")).first()[0])["decision"] in ("a", "b")
    cli.main(["multi-score", out("a.json"), "--output", out("scored"), "--top-k", "2", "--use-model"])
    assert spark.read.json(out("scored")).count() == 2
    cli.main(["tool-pipeline", out("tools.json"), "--output", out("lines"), "--min-score", "0", "--threshold", "0", "--target-pairs", "3", "--format", "sharegpt"])
    assert spark.read.json(out("lines")).count() == 3
    cli.main(["curate", out("a.json"), "--output", out("curated"), "--threshold", "0"])
    assert spark.read.parquet(out("curated/all_rated")).count() == 4


@pytest.mark.parametrize("value", [1, 2.5, True, None, "a", "it's", [1, {"b": None}], {"z": [True, False, []], "a": {"k": "x\ny \"q\" \\"}}, "[1]", -3, 10**20, []])
def test_values_keep_their_types(spark, value):
    from curatrix.operators import execution

    order = lambda v: {k: order(v[k]) for k in sorted(v)} if isinstance(v, dict) else [order(x) for x in v] if isinstance(v, list) else v
    df = spark.createDataFrame([(json.dumps({"v": value}),)], "t string").select(F.from_json("t", values.ARGS)["v"].alias("v"))
    row = df.select(values.written(F.col("v")), values.as_json(F.col("v"))).first()
    assert row[0] == repr(order(value)) and json.loads(row[1] or "null") == value
    listed = tool_parsers.frame(spark, tool_parsers.json_tools([{"name": "echo", "description": "d"}]))
    step = F.struct(F.lit(1).alias("step"), F.lit("t").alias("thought"), F.lit("echo").alias("tool"), F.create_map(F.lit("v"), "v").alias("args"))
    ran = execution.execute_examples(df.select(F.lit(1).alias("example_id"), F.array(step).alias("reasoning_path")), listed, "real", implementations={"echo": lambda v: [v]})
    assert json.loads(ran.select(values.as_json(F.col("execution_result.output"))).first()[0]) == [value]
    told = execution.execute_examples(df.select(F.lit(1).alias("example_id"), F.array(step).alias("reasoning_path")), listed, "simulated", "```json\n{args_json}\n```", provider="echo")
    assert json.loads(told.select(values.as_json(F.col("reasoning_path")[0]["actual_result"])).first()[0]) == {"v": value}


def _random_tools(rng, n):
    types = ["string", "integer", "number", "object", "any", "path", "Odd", "dataset"]
    nodes = [(f"t{k:03d}", f"c{k % 3}", rng.choice(types), k) for k in range(n)]
    params = [(t, f"p{i}", rng.choice(types)) for t, *_ in nodes for i in range(rng.randrange(0, 3))]
    counts = {t: sum(p[0] == t for p in params) for t, *_ in nodes}
    return [(t, t, c, o, counts[t], k) for t, c, o, k in nodes], params


def test_factored_graph_equals_the_edges(spark):
    import random

    rng = random.Random(6)
    rows, wants = _random_tools(rng, 40)
    nodes = spark.createDataFrame(rows, "tool_id string, name string, category string, output_type string, n_inputs int, place int")
    params = spark.createDataFrame(wants, "tool_id string, param string, param_type string")
    edge = graph.edges(nodes, params)
    same = lambda a, b: sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert same(graph.type_degrees(nodes, params), graph.degrees(nodes, edge).select("tool_id", "out_degree", "in_degree"))
    assert graph.type_statistics(nodes, params).first().asDict() == graph.statistics(nodes, edge).first().asDict()
    chains = spark.createDataFrame([(f"c{k}", rng.choices([r[0] for r in rows] + ["none"], k=rng.randrange(1, 5))) for k in range(30)], "chain_id string, chain array<string>")
    assert same(graph.type_chain_issues(chains, nodes, params), graph.chain_issues(chains, nodes, edge))
    place = {r[0]: r[5] for r in rows}
    after: dict = {}
    for src, dst in edge.select("src", "dst").distinct().collect():
        after.setdefault(src, set()).add(dst)

    def search(chain, most):
        for dst in sorted(after.get(chain[-1], ()), key=place.get) if len(chain) < most else ():
            if dst not in chain:
                yield [*chain, dst]
                yield from search([*chain, dst], most)

    for least, most, entries, each in ((2, 4, 5, 10), (3, 4, 3, 25), (2, 3, 50, 1)):
        first = [r[0] for r in rows if r[4] <= 1][:entries]
        want = []
        for e in first:
            want += [(e, k, c) for k, c in enumerate([c for c in search([e], most) if len(c) >= least][:each], 1)]
        got = graph.first_chains(nodes, params, None, least, most, entries, each).select("entry", "number", "chain").collect()
        assert sorted(map(tuple, got)) == sorted(want)
    wanted = spark.createDataFrame([(rng.choice(rows)[0], rng.choice(rows)[0]) for _ in range(60)], "src string, dst string").where("src <> dst").distinct()
    all_ = {}
    for r in graph.bridges(edge, wanted).collect():
        if len(r.bridge) < 2:
            all_.setdefault((r.src, r.dst), []).append(tuple(r.bridge))
    want = sorted((s, d, b) for (s, d), found in all_.items() for b in sorted(found, key=lambda b: place[b[0]] if b else 0)[:3])
    assert sorted((r.src, r.dst, tuple(r.bridge)) for r in graph.first_bridges(wanted, nodes, params, 3).collect()) == want


def test_chains_of_many_tools_of_one_type(spark):
    """Twenty thousand tools that all feed each other: no table of their pairs."""
    tools_ = spark.range(20_000).select(F.format_string("t%05d", "id").alias("tool_id"), F.lit("n").alias("name"), F.lit("c").alias("category"), F.lit("string").alias("output_type"), F.lit(1).alias("n_inputs"), F.col("id").alias("place"))
    params = tools_.select("tool_id", F.lit("p").alias("param"), F.lit("string").alias("param_type"))
    got = graph.first_chains(tools_, params).collect()
    assert len(got) == 50 and {r.entry for r in got} == {f"t0000{k}" for k in range(5)}
    s = graph.type_statistics(tools_, params).first()
    assert s.n_edges == 20_000 * 19_999 and s.max_out_degree == s.max_in_degree == 19_999


@pytest.mark.parametrize("target, most", [(1, 100), (5, 100), (7, 9), (60, 100), (0, 10)])
def test_asking_stops_at_the_target_and_resumes(spark, tmp_path, target, most):
    from curatrix.streaming.until import until

    log = str(tmp_path / "log")
    open(log, "w").close()

    class EveryOther:
        """Notes each call in a file and fails on every second one."""

        def generate(self, prompt, temperature=None, max_tokens=None):
            with open(log, "a") as f:
                f.write(prompt + "\n")
            number = int(prompt[1:])
            if number % 2:
                raise RuntimeError("down")
            return f"answer {number}"

    models.register_provider("every other", lambda **_: EveryOther())
    rows = spark.range(100).select(F.col("id").alias("number")).repartition(5)
    attempt = lambda some: models.ask(some, F.concat(F.lit("#"), "number"), provider="every other").withColumn("accepted", F.col("raw").isNotNull())
    # Asked one after the other: the call that reaches the target is the last.
    calls = min(most, next((k + 1 for k in range(100) if k // 2 + 1 >= target), 100)) if target else 0
    for _ in range(2):
        got = until(rows, attempt, target, str(tmp_path / "work"), "number", most)
        assert [r.raw for r in got.orderBy("number").collect()] == [f"answer {k}" for k in range(0, calls, 2)][:target]
        asked = open(log).read().split()
        assert sorted(asked) == sorted(f"#{k}" for k in range(calls))
    # A half-written batch is tried again, whole ones are not.
    if calls > 1:
        last = max(p for p in (tmp_path / "work").iterdir() if p.name.startswith("attempts"))
        (last / "_SUCCESS").unlink()
        again = int(last.name.rpartition("-")[2])
        assert until(rows, attempt, target, str(tmp_path / "work"), "number", most).count() == len(range(0, calls, 2)[:target])
        assert sorted(open(log).read().split()[calls:]) == sorted(f"#{k}" for k in range(again, calls))


def test_chain_first_by_command(spark, tmp_path, monkeypatch):
    from curatrix import cli

    monkeypatch.setattr(cli, "_session", lambda: spark)
    log = str(tmp_path / "log")
    open(log, "w").close()

    class Chains:
        """Gives a chain of the first two tools it is shown, as a list or an object, and a request for it; some chains have unknown tools."""

        def generate(self, prompt, temperature=None, max_tokens=None):
            import json

            with open(log, "a") as f:
                f.write(prompt.split(" ")[0] + "\n")
            if prompt.startswith("CHAIN"):
                names = [t["name"] for t in json.loads(prompt[prompt.index("[") :])]
                steps = [{"tool": n, "thought": "t", "args": {"n": k, "from": [k - 1]}} for k, n in enumerate(names[:2], 1)]
                if "c1" in names[0]:
                    steps[1]["tool"] = "unknown"
                return json.dumps(steps) if "c0" in names[0] else "Here: " + json.dumps({"steps": steps, "final_answer": "ok"})
            return json.dumps({"query": "Please " + prompt.split(" ", 1)[1]})

    models.register_provider("chains", lambda **_: Chains())
    names = [f"c{c}_tool{k}" for c in range(3) for k in range(3)]
    (tmp_path / "tools.json").write_text(json.dumps([{"name": n, "description": "d", "category": n[:2], "parameters": [{"name": "n", "type": "integer", "required": True}]} for n in names]))
    (tmp_path / "prompts").mkdir()
    (tmp_path / "prompts" / "p.json").write_text(json.dumps({"chain_generation": "CHAIN {min_steps}-{max_steps} {tools_json}", "query_synthesis": "ASK {tools_used}: {chain_steps} {final_result}", "tool_instruction_generation": "[{\"question\": \"Use {tool_name}\"}]"}))
    cli.main(["tool-generate-chain", str(tmp_path / "tools.json"), "--output", str(tmp_path / "out"), "--target-pairs", "4", "--provider", "chains", "--prompts", str(tmp_path / "prompts")])
    made = spark.read.json(str(tmp_path / "out")).collect()
    # Of the three categories in turn, c1 never gives a sound chain.
    assert sorted(r.instruction for r in made) == sorted(f'Please {c}_tool0, {c}_tool1: 1. {c}_tool0({{"n":1,"from":[0]}})\n2. {c}_tool1({{"n":2,"from":[1]}}) {a}' for c, a in (("c0", "The task is complete."), ("c2", "ok")) for _ in range(2))
    assert {r.generation_method for r in made} == {"chain_first"} and {r.difficulty for r in made} == {"medium"} and made[0].reasoning_path[1].args.n == 2
    assert sorted(open(log).read().split()) == ["ASK"] * 4 + ["CHAIN"] * 6


def test_templates_are_filled_by_their_callers(spark):
    from curatrix.sources.templates import TEMPLATES

    p = spark.createDataFrame([(1, "c", "f", "some text", "q", "a", "ds", 5.0, "s")], "idx long, chunk_id string, source_file string, content string, question string, answer string, dataset string, rating double, source string")
    path = f"array<{values.STEP}>"
    ex = spark.createDataFrame([(1, 1, "do it", "done")], "example_id long, idx long, instruction string, final_answer string").withColumn("reasoning_path", F.from_json(F.lit('[{"step": 1, "thought": "t", "tool": "x", "args": {"k": [1]}, "actual_result": 3, "status": "success"}]'), path))
    listed = tool_parsers.frame(spark, tool_parsers.json_tools([{"name": "x", "description": "d", "category": "c", "parameters": [{"name": "k"}]}])).withColumn("idx", F.lit(1))
    seen = []
    original = models.ask

    def watch(df, prompt, *args, **kw):
        seen.extend(r[0] for r in df.select(prompt.alias("p")).collect())
        return original(df, prompt, *args, **kw)

    models.ask, kept = watch, models.ask
    try:
        calls = {
            "qa_generation": lambda t: models.generate_pairs(p, t), "code_qa_generation": lambda t: models.generate_pairs(p, t), "cot_generation": lambda t: models.generate_pairs(p, t), "qa_rating": lambda t: models.rate_pairs(p, t),
            "qa_enrichment": lambda t: models.enrich(p, t), "cot_enhancement": lambda t: models.add_reasoning(p, t), "qa_comparison_evaluation": lambda t: models.judge_datasets(p, t),
            "qa_comparison_selection": lambda t: models.decide(spark.createDataFrame([("a", 3.0, "{}", True)], "dataset string, score double, metrics string, wins boolean"), t),
            "tool_instruction_generation": lambda t: models.instructions_for_tools(listed, t, 2), "tool_quality_rating": lambda t: models.rate_examples(ex, t), "step_quality_rating": lambda t: models.rate_steps(ex, t),
            "tool_semantic_verification": lambda t: models.verify(ex, t), "chain_generation": lambda t: models.chain_examples(models.chain_attempts(listed, 1, 1), t, TEMPLATES["query_synthesis"]),
            "tool_solution_single": lambda t: pipelines.tool_examples(listed, 1),
        }
        for name, call in calls.items():
            seen.clear()
            call(TEMPLATES[name])
            assert seen and seen[0], name
            import re

            for text in seen:
                left = set(re.findall(r"\{(\w+)\}", text or ""))
                assert not left, (name, left)
    finally:
        models.ask = kept


def _clustered(rng, n, groups, dim=12):
    centers = rng.normal(size=(groups, dim)) * 5
    v = centers[rng.integers(0, groups, n)] + rng.normal(size=(n, dim)) * 0.05
    v[::17] *= 1e-7
    v[5] = 0
    v[8] = v[3]
    return v


@pytest.mark.parametrize("block, pivots", [(16, 4), (40, 30), (512, 256)])
def test_nearest_earlier_rows_with_pruning_by_brute_force(spark, block, pivots):
    rng = np.random.default_rng(4)
    v = _clustered(rng, 300, 7)
    at = rng.permutation(300)
    at[::50] = 3
    df = spark.createDataFrame([(int(k), x.tolist()) for k, x in zip(at, v, strict=True)], "idx long, embedding array<double>").repartition(3)
    norm = np.linalg.norm(v, axis=1)
    far = 1 - v @ v.T / (norm[:, None] * norm[None, :] + 1e-8)
    far[at[None, :] >= at[:, None]] = np.inf
    # Rows of one place share what is found for any of them.
    least: dict = {}
    for k, x in zip(at.tolist(), far.min(axis=1).tolist(), strict=True):
        least[k] = min(least.get(k, np.inf), x)
    got = sorted((r.idx, r.diversity) for r in scoring.diversity_before(df, block=block, pivots=pivots).collect())
    want = sorted((k, min(10.0, 10 * least[k]) if least[k] < np.inf else 5.0) for k in at.tolist())
    assert [k for k, _ in got] == [k for k, _ in want] and np.allclose([x for _, x in got], [x for _, x in want], atol=1e-9)
    assert scoring.diversity_before(df.limit(0)).count() == 0


def test_fewer_blocks_are_compared_as_the_table_grows(spark):
    rng = np.random.default_rng(5)
    share = []
    for n in (400, 1600, 6400):
        centers = rng.normal(size=(n // 40, 12)) * 5
        v = centers[rng.integers(0, n // 40, n)] + rng.normal(size=(n, 12)) * 0.02
        df = spark.createDataFrame([(k, x.tolist()) for k, x in enumerate(v)], "idx long, embedding array<double>")
        share.append(scoring.compared_share(df, block=16, pivots=512).first().share)
    assert share[0] > share[1] > share[2] and share[2] < 0.1


@pytest.mark.parametrize("most", [125_000, 3])
def test_coverage_by_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(coverage, "BROADCAST_VECTORS", most)
    rng = np.random.default_rng(6)
    v, p = rng.normal(size=(200, 5)), rng.normal(size=(20, 5))
    v[3:6] = p[0]
    df = spark.createDataFrame([(x.tolist(),) for x in v], "embedding array<double>").repartition(3)
    picks = spark.createDataFrame([(x.tolist(),) for x in p], "embedding array<double>")
    mean = np.linalg.norm(v[:, None] - p[None], axis=2).min(axis=1).mean()
    assert coverage.coverage_score(df, picks).first().coverage == pytest.approx(1 / (1 + mean), abs=1e-12)
    assert coverage.coverage_score(df.limit(0), picks).first().coverage == coverage.coverage_score(df, picks.limit(0)).first().coverage == 0.0


def test_errors_come_next_to_what_was_read(spark, tmp_path):
    (tmp_path / "good.json").write_text(json.dumps([{"question": "q", "size": 1}, "text", {"question": "r"}, {"question": "s", "size": "x"}, 3, {"size": 4, "more": 1}]))
    (tmp_path / "cut.json").write_text('[{"question": "q"}')
    (tmp_path / "object.json").write_text('{"a": []}')
    (tmp_path / "none.json").write_text("[]")
    (tmp_path / "empty.json").write_text("")
    paths = [str(tmp_path / f"{n}.json") for n in ("good", "cut", "object", "none", "empty", "gone")]
    good, wrong = readers.split_errors(readers.checked_array(spark, paths, "question string, size long"), str(tmp_path / "out"))
    assert sorted((r.idx, r.question, r["size"]) for r in good.collect()) == [(0, "q", 1), (2, "r", None), (5, None, 4)]
    told = [(readers.stem(r.path), r.place, r.cause) for r in wrong.collect()]
    assert set(told) == {("cut", None, "no JSON"), ("empty", None, "no JSON"), ("object", None, "no array"), ("gone", None, "no such file"), ("good", 1, "no object"), ("good", 3, "does not fit the schema"), ("good", 4, "no object")} and len(told) == 7
    none = readers.checked_array(spark, [paths[-1]], "question string")
    assert [r.error.cause for r in none.collect()] == ["no such file"]


def test_rows_get_their_own_shape_back(spark):
    rows = [
        {"prompt": "p", "response": "r", "tags": ["x", {"y": None}]}, {"question": "q", "answer": "a", "rating": 1, "n": 2.5}, {"question": "q", "reasoning": "why", "answer": "a"},
        {"messages": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}], "id": "z"}, {"conversations": [{"role": "user", "content": "u"}, {"role": "assistant", "content": "c"}]}, {}, "text", 3, [1],
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in rows] + [("no json",), (None,)], "value string")
    read = curation.read_any(df)
    assert sorted((r["shape"], r.question, r.answer, r.reasoning) for r in read.where("shape = 'conversation'").collect()) == [("conversation", "h", "g", None), ("conversation", "u", "c", None)]
    got = [json.loads(r.value) for r in curation.restored(read.withColumns({"rating": F.lit(7.5), "clarity": F.lit(None).cast("int")})).collect()]
    new = {"rating": 7.5, "clarity": None}
    want = [{**rows[0], "question": "p", "answer": "r", **new}, {**rows[1], **new}, {**rows[2], **new}, {**rows[3], **new}, {**rows[4], **new}, {"question": "", "answer": "", **new}]
    assert sorted(json.dumps(r, sort_keys=True) for r in got) == sorted(json.dumps(r, sort_keys=True) for r in want)


def test_second_run_encodes_nothing(spark, tmp_path):
    log = str(tmp_path / "log")
    open(log, "w").close()

    def make():
        def encode(texts):
            with open(log, "a") as f:
                f.write("".join(t + "\n" for t in texts))
            return [[float(len(t)), 1.0] for t in texts]

        return encode

    texts = ["one", "two words", "one", None, ""]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, embedding_text string")
    for more in ([], [], ["three"]):
        now = df.union(spark.createDataFrame([(9, t) for t in more], df.schema))
        got = {r.id: r.embedding for r in coverage.embed_cached(now, make, str(tmp_path / "vectors"), buckets=4).collect()}
        assert got == {k: None if t is None else [float(len(t)), 1.0] for k, t in [*enumerate(texts), *((9, t) for t in more)]}
    assert sorted(open(log).read().split("\n")) == sorted(["one", "two words", "", "three", ""])
    other = coverage.embed_cached(df, make, str(tmp_path / "vectors"), model="other", buckets=4)
    assert other.where("embedding IS NOT NULL").count() == 4 and len(open(log).read().split("\n")) == 8


def test_places_of_wide_rows_are_whole(spark):
    """The counts of the ranges and the rows come from the same ranges, however few bytes the counts need."""
    from curatrix.operators.order import numbered

    wide = spark.range(30_000).select("id", F.transform(F.sequence(F.lit(1), F.lit(64)), lambda i: F.rand(1) + i).alias("v"))
    got = numbered(wide, F.desc("id")).select("id", "place", F.size("v").alias("n")).collect()
    assert sorted((r.place, r.id, r.n) for r in got) == [(k, 29_999 - k, 64) for k in range(30_000)]


def test_chains_may_name_tools_that_are_not_shown(spark):
    rows = [(i, f"t{i}", f"n{i}", "d", "c" if i < 6 else None) for i in range(8)]
    tools = spark.createDataFrame(rows, "idx int, tool_id string, name string, description string, category string")
    found = lambda template: [(r.category, r.chain, r.length) for r in models.model_chains(tools, template, 2, 3, shown=2, provider="echo").collect()]
    assert found('[{"chain": ["t5", "t0", "t5"]}]') == [("c", ["t5", "t0", "t5"], 3)]
    assert found('[{"chain": ["t6", "t7"]}]') == [("other", ["t6", "t7"], 2)]
    assert found('[{"chain": ["t5", "t6"]}]') == found('[{"chain": ["t5", "gone"]}]') == found('[{"chain": ["t5", null]}]') == []


def test_graph_edges_holds_every_edge(spark, tmp_path):
    from curatrix.plans import catalogue

    sizes = [k * 5 % 23 for k in range(40)]
    parts = [(k, f"part {k}", "b", "t", size, 1.0) for k, size in enumerate(sizes)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double").write.parquet(f"{tmp_path}/part.parquet")
    got = sorted(tuple(r) for r in catalogue.QUERIES["graph_edges"](spark, str(tmp_path)).collect())
    inputs = [(k, "size", "integer") for k in range(40)] + [(k, "label", "string") for k in range(40) if sizes[k] % 2 == 0]
    gives = [catalogue._TYPES[size % 7] for size in sizes]
    score = lambda o, w: 1.0 if o == w else 0.8 if w == "any" else 0.6
    want = sorted((f"tool_{a}", f"tool_{b}", p, score(gives[a], w)) for a in range(40) for b, p, w in inputs if a != b and w in graph.LATTICE[gives[a]])
    assert got == want


def test_catalogues_of_several_files_are_one_list(spark, tmp_path):
    rows = spark.range(40).select((99 - F.col("id")).alias("at"), F.concat(F.lit("Tool\n"), "id").alias("name"))
    path = sinks.json_arrays(rows.repartition(3), str(tmp_path / "tools.yaml"), "at", "tools", {"version": "1"}, per_file=7)
    files = sorted(tmp_path.glob("tools.yaml/file=*/part-*"))
    assert [len(d["tools"]) for d in (json.loads(f.read_text()) for f in files) if d["version"] == "1"] == [7] * 5 + [5]
    assert sorted((r.idx, r.name) for r in readers.tools(spark, path).collect()) == [(k, f"Tool\n{39 - k}") for k in range(40)]
    bare = sinks.json_arrays(rows.limit(0), str(tmp_path / "none.json"), "at")
    assert [f.read_text().strip() for f in tmp_path.glob("none.json/*/part-*")] == ["[]"] and readers.tools(spark, bare).count() == 0


def test_generated_pairs_hold_the_text_as_it_is(spark):
    texts = ["a,]b, ,c ,}", 'of"him" said ["k"] ("q")', "the {text} of {content} {n_pairs_min}", "a\x0bb\x85c d\x1c", "first\r\nlast\xa0", ""]
    chunks = spark.createDataFrame([(k, "s", t) for k, t in enumerate(texts)], "chunk_id int, source_file string, content string")
    got = [r.answer for r in models.generate_pairs(chunks, "Ask about:\n{content}", sanitise=False).orderBy("chunk_id").collect()]
    assert got == [*texts[:4], "last\xa0", "Ask about:"]
    assert models.generate_pairs(chunks.where("chunk_id = 1"), "{content}").first().answer == "of'him' said ['k'] ('q')"


def test_answers_about_tools_are_not_broadcast(spark, tmp_path):
    # A file of known small size.
    spark.createDataFrame([(k, f"t{k}", f"n{k}", "d") for k in range(20)], "idx int, tool_id string, name string, description string").write.parquet(f"{tmp_path}/tools")
    tools_ = spark.read.parquet(f"{tmp_path}/tools")
    made = pipelines.tool_examples(tools_, 1)
    assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.tool_id for r in made.collect()) == sorted(f"t{k}" for k in range(20))


def test_edges_meet_in_shares_and_are_not_broadcast(spark, tmp_path):
    # A file of known small size.
    rows = [(f"t{k}", f"n{k}", "c", ["integer", "Any", "odd", "string", None][k % 5], 1, k) for k in range(30)]
    spark.createDataFrame(rows, "tool_id string, name string, category string, output_type string, n_inputs int, place int").write.parquet(f"{tmp_path}/nodes")
    wanted = [(f"t{k}", "p", ["Integer", "any", "ODD", "array"][k % 4]) for k in range(30)]
    spark.createDataFrame(wanted, "tool_id string, param string, param_type string").write.parquet(f"{tmp_path}/params")
    nodes, params = spark.read.parquet(f"{tmp_path}/nodes"), spark.read.parquet(f"{tmp_path}/params")
    takes = lambda o, w: o is not None and w.lower() in graph.LATTICE.get(o.lower(), [o.lower()])
    want = sorted((r[0], d) for r in rows for d, _, w in wanted if r[0] != d and takes(r[3], w))
    for spread in ({}, {"spread": 1}, {"spread": 3}):
        found = graph.edges(nodes, params, **spread)
        shown = found._jdf.queryExecution().executedPlan().toString()
        # Only the lattice is broadcast.
        assert shown.count("BroadcastExchange") == 1 and shown.count("SortMergeJoin") == 1
        assert sorted((r.src, r.dst) for r in found.collect()) == want


def test_results_of_steps_are_not_broadcast(spark, tmp_path):
    from curatrix.operators import execution

    # Files of known small size.
    spark.createDataFrame([(k, f"t{k}", f"n{k}", "d") for k in range(20)], "idx int, tool_id string, name string, description string").write.parquet(f"{tmp_path}/tools")
    tools_ = spark.read.parquet(f"{tmp_path}/tools").withColumns({"returns": F.lit(None).cast("struct<type:string>"), "parameters": F.lit(None).cast("array<struct<name:string,required:boolean>>")})
    made = pipelines.tool_examples(tools_, 1)
    made.write.parquet(f"{tmp_path}/made")
    given = spark.read.schema(made.schema).parquet(f"{tmp_path}/made")
    for mode in ("simulated", "multi_agent"):
        ran = execution.execute_examples(given, tools_, mode)
        assert "Broadcast" not in ran._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.tool_id, r.good) for r in ran.select("tool_id", F.col("execution_result.success").alias("good")).collect()) == sorted((f"t{k}", True) for k in range(20))


def test_asking_leaves_other_columns_as_they_are(spark):
    rows = [(2**60 + 1, float("nan"), [1, None], None), (None, 1.5, None, "b"), (7, None, [], "")]
    given = spark.createDataFrame(rows, "id long, x double, v array<long>, t string").withColumn("w", F.parse_json(F.lit('{"a": [1, null]}')))
    got = {r.t: r for r in models.ask(given, F.col("t"), provider="echo").withColumn("w", F.to_json("w")).collect()}
    assert [(r.id, str(r.x), r.v, r.w, r.raw, r.error) for r in (got[None], got["b"], got[""])] == [
        (2**60 + 1, "nan", [1, None], '{"a":[1,null]}', None, None), (None, "1.5", None, '{"a":[1,null]}', "b", None), (7, "None", [], '{"a":[1,null]}', "", None),
    ]
    assert models.ask(given.where("false"), F.col("t")).count() == 0

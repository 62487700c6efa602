import duckdb
import numpy as np

from icuflow.llm import chat, queries


def test_named_markers_in_many_styles():
    for s, u, a in (("System: ", "User: ", "Assistant: "), ("### Context: ", "### Human: ", "### AI: "), ("[system] ", "[user] ", "[assistant] "),
                    ("<|system|> ", "<|user|> ", "<|assistant|> "), ("**Context:** ", "**Q:** ", "**A:** ")):
        turns = chat.parse([f"{s}Be brief.\n{u}What is it?\nIt has\n\ntwo lines\n{a}A thing.\n{u}Thanks"])[0]
        assert turns == [("system", "Be brief."), ("user", "What is it?\nIt has\n\ntwo lines"), ("assistant", "A thing."), ("user", "Thanks")]


def test_numbered_speakers_get_roles_from_their_neighbours():
    turns = chat.parse(["System: x\nSpeaker 1: one\nSpeaker 2: two\nSpeaker 1: three", "Speaker 1: one\nSpeaker 2: two", "Speaker 4: a\nUser: b"])
    assert [[r for r, _ in t] for t in turns] == [["system", "user", "assistant", "user"], ["user", "assistant"], ["assistant", "user"]]


def test_viterbi_against_all_paths():
    import itertools
    rng = np.random.default_rng(2)
    for _ in range(20):
        m, f = rng.integers(0, 5, 4), rng.random((4, 3)) < 0.4
        shape = np.where(f[:, None, :], np.log(chat._FEATURES), np.log(1 - chat._FEATURES)).sum(2)

        def weight(path):
            total = np.log(chat._FIRST[path[0] % 3]) if path[0] < 3 else -np.inf
            for t, s in enumerate(path):
                total += (np.log(chat._BEGIN[s, m[t]]) if s < 3 else np.log(chat._GO_ON[m[t]])) + shape[t, s % 3]
                if t:
                    p = path[t - 1]
                    total += np.log(chat._END * chat._NEXT[p % 3, s]) if s < 3 else (np.log(1 - chat._END) if s % 3 == p % 3 else -np.inf)
            return total

        best = max(itertools.product(range(6), repeat=4), key=weight)
        got = chat.viterbi([m], [f], chat._FIRST)[0].tolist()
        assert abs(weight(tuple(got)) - weight(best)) < 1e-9


def test_edge_cases(spark):
    assert chat.parse([None, "", "no marker at all"]) == [[], [], [("user", "no marker at all")]]
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digest(empty).collect() == []
    rows = [(1, 0, "user", None, 1), (1, 1, None, "x", 1), (None, None, "user", "y", 1), (2, 300, "user", "late", 1), (2, 0, "user", "early", 1)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int")
    got = {(r["conv_id"], r["part"]): (r["n_turns"], r["roles"]) for r in chat.digest(df).collect()}
    assert got == {(1, 0): (2, "user,assistant"), (None, 0): (1, "user"), (2, 0): (1, "user"), (2, 1): (1, "user")}


def test_long_conversations_are_parsed_as_if_uncut(spark):
    ids = [r[0] for r in spark.range(200).selectExpr("id", "pmod(xxhash64(id), 5) s").where("s = 4").limit(3).collect()]
    rnd = np.random.default_rng(7)
    rows = []
    for c in ids[:2]:
        # An odd number of turns before the cut: parts begin with either speaker, and some turns repeat a speaker.
        role = 0
        for k in range(1000):
            rows.append((c, k + 3, ("user", "assistant")[role], "is it so?" if rnd.random() < 0.3 else "word " * int(rnd.integers(1, 30))))
            role = role if rnd.random() < 0.05 else 1 - role
    rows += [(ids[2], k, ("user", "assistant")[k % 2], "x") for k in range(1, 601)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {}
    for r in sorted(chat.digest(df).collect()):
        got.setdefault(r["conv_id"], []).extend(r["roles"].split(","))
    for c in ids:
        mark = {"user": "Speaker 1: ", "assistant": "Speaker 2: "}
        text = "\n".join(mark[r[2]] + r[3] for r in sorted(r for r in rows if r[0] == c))
        whole = [r for r, _ in chat.parse([text])[0]]
        _, (m,), (f,) = chat._read([text])
        shape = np.where(f[:, None, :], np.log(chat._FEATURES), np.log(1 - chat._FEATURES)).sum(2)

        def weight(roles):
            x = [chat.ROLES.index(r) for r in roles]
            return (np.log(chat._FIRST[x[0]]) + sum(np.log(chat._END * chat._NEXT[p, q]) for p, q in zip(x[:-1], x[1:], strict=True))
                    + sum(np.log(chat._BEGIN[q, k]) + e[q] for q, k, e in zip(x, m, shape, strict=True)))

        # Paths can tie, so random turns need the score of the uncut parse; alternating ones its roles.
        assert len(got[c]) == len(whole) and abs(weight(got[c]) - weight(whole)) < 1e-6
        assert c != ids[2] or got[c] == whole == ["user", "assistant"] * 300


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    want = con.execute(chat.SQL).df()
    got = queries.op6_chat_format(spark, sf).toPandas()[list(want.columns)]
    key = ["conv_id", "part"]
    assert got.sort_values(key).reset_index(drop=True).astype(str).equals(want.sort_values(key).reset_index(drop=True).astype(str))


def test_a_marker_of_another_style_is_text():
    turns = chat.parse(["User: Is this right?\nAnswer: 42\nwhy?\nAssistant: Because."])[0]
    assert turns == [("user", "Is this right?\nAnswer: 42\nwhy?"), ("assistant", "Because.")]
    turns = chat.parse(["### Human: see\nQ: a\n[user] b\n**A:** c\n\\\\server\\x\n### AI: yes\nModel: T"])[0]
    assert turns == [("user", "see\nQ: a\n[user] b\n**A:** c\n\\\\server\\x"), ("assistant", "yes\nModel: T")]
    assert chat.parse(["Q: one?\nA: two\nUser: no marker here\nQ: three?\nA: four"])[0] == [
        ("user", "one?"), ("assistant", "two\nUser: no marker here"), ("user", "three?"), ("assistant", "four")]


def _sql_rows(rows):
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    return sorted(con.execute(chat.SQL).fetchall())


def test_any_texts_and_roles_render_as_the_sql_does(spark):
    """Lines like markers of every style, backslashes, blank and odd lines, and roles beyond the three keep every character."""
    rnd = np.random.default_rng(11)
    starts = ["User: ", "assistant:", "### Response: ", "[user] ", "<|system|> ", "**A:** ", "Speaker 2: ", "Answer: ", "\\", "\\User: ", "\\\\", " User: ", "<|tool|> ",
              "<||>", "a:", "Q:", "", "##", "# User", "é ", "\r", "context: "]
    rows = []
    for c in range(120):
        for k in range(int(rnd.integers(1, 9))):
            lines = [starts[int(rnd.integers(len(starts)))] + ("word " * int(rnd.integers(0, 4))).strip() for _ in range(int(rnd.integers(1, 5)))]
            role = ["user", "assistant", "user", "assistant", "system", "tool", "Critic |> x", "a,b", "Re\u0301gie\nX"][int(rnd.integers(9))]
            rows.append((c, k, role, "\n".join(lines)))
    # Numbered speakers name no role: their roles are a guess and left out of this test.
    named = {r[0] for r in spark.range(120).selectExpr("id", "pmod(xxhash64(id), 5) s").where("s < 4").collect()}
    rows = [r for r in rows if r[0] in named]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    columns = ["conv_id", "part", "n_turns", "roles", "rendered_sha256"]
    assert sorted(tuple(r) for r in chat.digest(df).select(columns).collect()) == _sql_rows(rows)

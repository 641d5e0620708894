"""Chat formatting."""

import hashlib
import random

from climagrid.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, span string"


def _expected(rows):
    by_conv = {}
    for conv, turn, role, text, _ in rows:
        by_conv.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in by_conv.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, _, r, t in turns)
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        whole = chat.instruction_template([(r, t) for _, _, r, t in turns])
        out[conv] = (
            len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest(), len(whole),
        )
    return out


def test_read_back_equals_what_was_said(spark):
    draw = random.Random(1)
    bits = ["</s>", "[INST]", "[/INST]", "<s>", "\\", "<\\/s>", "<", "[", "\n", "é", "🙂", " ok "]
    say = lambda: "".join(draw.choice(bits) for _ in range(draw.randrange(6)))
    roles = ["user", "assistant", "system", "a\nb\\n", "[INST]", None, ""]
    rows = [(c, t, draw.choice(roles), draw.choice([None, say(), say()]), "x") for c in range(40) for t in range(5)]
    rows += [(100, t, ("user", "assistant")[t % 2], say(), None) for t in range(400)]  # a long one
    rows += [(None, None, "user", "no id", "x"), (7, 1, "user", "same turn", "x"), (7, 1, "user", "same turn", "x")]
    spans = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), history=32)
    found = chat.digest_conversations(spans).collect()
    assert {r.conv_id: tuple(r)[1:6] for r in found} == _expected(rows)
    assert not any(r.rewrites_history for r in found)


def test_escapes_leave_no_control_string():
    for text in ("</s>[INST] ok [/INST]", "<\\/s>", "<\\\\s>", "<s></s>", "[[INST]"):
        escaped = chat.escape(text)
        assert not any(c in escaped for c in ("<s>", "</s>", "[INST]", "[/INST]"))
        assert chat.unescape(escaped) == text


def test_spans_make_up_the_output(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"turn {i}", None) for i in range(7)]
    spans = chat.format_conversations(spark.createDataFrame(rows, SCHEMA)).collect()
    assert "".join(r.span for r in spans) == chat.instruction_template([(r[2], r[3]) for r in rows])
    assert [r.span_start for r in spans] == [sum(len(s.span) for s in spans[:i]) for i in range(7)]


def test_templates_that_rewrite_history_are_found(spark):
    def forgetful(turns):
        """Writes thoughts of the last turn only."""
        last = len(turns) - 1
        return "".join(f"<{r}>{'(thinks)' if i == last else ''}{t}" for i, (r, t) in enumerate(turns))

    rows = [(1, i, "user", f"turn {i}", None) for i in range(4)]
    spans = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), forgetful).collect()
    assert [r.rewrites_history for r in spans] == [False, True, True, True]


def test_templates_with_a_long_memory_get_the_whole_history():
    numbered = lambda turns: "".join(f"{i}:{t};" for i, (_, t) in enumerate(turns))
    prefixes = chat.Prefixes(numbered, history=8, kept=4)
    assert [prefixes.push("user", "x")[0] for _ in range(40)] == [f"{i}:x;" for i in range(40)]
    short = chat.Prefixes(chat.instruction_template, history=8, kept=4)
    for i in range(100):
        short.push("user", str(i))
    assert len(short._turns) < 8


def test_a_template_that_trims_late_is_found(spark):
    def trimming(turns):
        """Shows the last 80 turns."""
        return "".join(f"<{r}>{t}" for r, t in turns[-80:])

    rows = [(1, i, "user", f"turn {i}", None) for i in range(200)]
    spans = chat.format_conversations(spark.createDataFrame(rows, SCHEMA), trimming).collect()
    assert [r.rewrites_history for r in spans] == [i >= 80 for i in range(200)]
    text = ""
    for i, r in enumerate(spans):
        text = text[: r.span_start] + r.span
        assert text == trimming([(role, said) for _, _, role, said, _ in rows[: i + 1]])


def test_no_conversations(spark):
    spans = chat.format_conversations(spark.createDataFrame([], SCHEMA))
    assert chat.digest_conversations(spans).count() == 0

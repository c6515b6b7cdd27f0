from pyspark.sql import functions as F

from quizloom.functions.prompts import render, template_tokens, unknown_fields

NAMES = ["n", "context"]


def test_render_agrees_with_python_format(evaluate):
    templates = [
        "{n} about {context}",
        "({n}-1) {{n}} {context}{context}",
        "no fields",
        "",
        "line\n{n}\n{{{n}}}",
    ]
    context = "passage with {n} and {{braces}} and {context}"

    def filled(template):
        values = {"n": F.lit(3), "context": F.lit(context)}
        return render(template_tokens(template), values)

    assert evaluate(filled, templates) == [t.format(n=3, context=context) for t in templates]


def test_unknown_fields(evaluate):
    found = evaluate(
        lambda t: unknown_fields(template_tokens(t), NAMES), ["{n}{x} {{y}}", "a } b", "{context}"]
    )
    assert found == [["{x}"], ["}"], []]

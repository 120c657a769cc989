import json

import pytest

from sievework.operators import answers as A
from sievework.operators import services as C

SAMPLE = {"bool": True, "text": "t"}


def sample(kind, full=True):
    """A right answer of a kind; not full: without what may be absent."""
    if kind.startswith("["):
        return [sample(kind[1:-1], full)] * 2
    if kind in A.SHAPES:
        return {n: sample(t, full) for n, t, ok in A.fields(kind) if full or not ok}
    return A.words(kind)[-1] if kind.startswith("(") else "é" * int(kind.split("<=")[1]) if "<=" in kind else SAMPLE[kind]


def spoilt(kind, path=""):
    """(wrong answer, path) for every place of a kind, nested ones too."""
    yield (7, path) if kind != "bool" else ("true", path)
    if kind.startswith("("):
        yield "none of them", path
    if "<=" in kind:
        yield "x" * (int(kind.split("<=")[1]) + 1), path
    if kind.startswith("["):
        for bad, at in spoilt(kind[1:-1], f"{path}[1]"):
            yield [sample(kind[1:-1]), bad], at
    if kind in A.SHAPES:
        for n, t, ok in A.fields(kind):
            at = f"{path}.{n}" if path else n
            whole = sample(kind)
            if not ok:
                yield {k: v for k, v in whole.items() if k != n}, at
            yield whole | {n: None}, at
            for bad, where in spoilt(t, at):
                yield whole | {n: bad}, where


@pytest.mark.parametrize("shape", ["TranslationReview", "QAPairSelection", "TranslationSelection", "TranslationGateRewrite", "TranslationFix", "TranslationPickById", "PairAdjustment"])
def test_every_place_of_a_shape(spark, shape):
    """As columns and call by call alike: accepted, or refused at the place that is wrong."""
    right = [sample(shape), sample(shape, False), sample(shape) | {"more": 1}]
    wrong = list(spoilt(shape))
    texts = [json.dumps(x, ensure_ascii=False) for x in right] + [json.dumps(x) for x, _ in wrong] + [None, "", "{", json.dumps(right[0])[:-1]]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, raw string").coalesce(1)
    got = {r.i: r for r in A.typed_answers(df, "raw", shape).collect()}
    for i, t in enumerate(texts):
        if i < len(right):
            assert got[i].problem is None and got[i].value.asDict(True) == A.parser(shape)(t)
        else:
            assert got[i].value is None
            if i < len(right) + len(wrong):
                assert got[i].problem == A.check(wrong[i - len(right)][0], shape) and got[i].problem.startswith(f"{wrong[i - len(right)][1]}: ")
            else:
                assert got[i].problem == "not JSON"
    assert set(got[1].value.asDict(True)) == {n for n, _, _ in A.fields(shape)}


def test_all_shapes_hold_together():
    assert len(A.SHAPES) == 22
    for shape in A.SHAPES:
        assert A.check(sample(shape), shape) is None and A.check(sample(shape, False), shape) is None and A.ddl(shape).startswith("struct<")
        for bad, at in spoilt(shape):
            assert A.check(bad, shape).startswith(f"{at}: ")


def test_what_is_wrong_goes_into_the_next_turn(spark):
    def client(turns):
        said = turns[-1]["content"]
        return json.dumps({"ranking": ["C2", "C1"], "selected_id": "C2" if "selected_id: one of C1, C2" in said else "C7"})

    df = spark.createDataFrame([(1,)], "id int")
    row = C.llm_stage(df, client, "{id}", "out", parse=A.parser("TranslationPickById"), reprompts=1).first()
    assert json.loads(row.out) == {"ranking": ["C2", "C1"], "selected_id": "C2"} and row.out_reprompt_rounds == 1

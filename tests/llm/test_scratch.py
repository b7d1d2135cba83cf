"""Who owns intermediate tables: the call that wrote them, never the process."""

import __spark_entry__ as E
import corpus_pipeline
from strata.llm.common import materialise, scratch, table
from strata.session import path_exists

SF = "/root/testdata/sf0.001"


def _folder(df):
    return df.inputFiles()[0].rsplit("/", 1)[0]


def test_a_block_removes_its_tables_but_lasting_ones(llm):
    with scratch(llm):
        outer = materialise(llm.range(3), "outer")
        with scratch(llm):
            inner = _folder(materialise(llm.range(3), "inner"))
            lasting = materialise(llm.range(5), "lasting", lasting=True)
        assert not path_exists(llm, inner) and lasting.count() == 5
        names = [_folder(outer), _folder(lasting)]
    free = materialise(llm.range(2), "free")
    assert not any(path_exists(llm, n) for n in names) and free.count() == 2


def test_runs_do_not_remove_each_others_tables(llm):
    """Results built before other runs are read after them."""
    one, seven = (E.queries()[n](llm, SF) for n in ("op1_substring_dedup", "op7_suffix_array_dedup"))
    first, second = (corpus_pipeline.run(llm, SF) for _ in range(2))
    docs = table(llm, SF, "documents")
    stages = [f(llm, docs, SF) for _, f in corpus_pipeline.STAGES[:3]]
    n = docs.count()
    assert one.count() == seven.count() == n
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(first) == ids(second)
    assert [s.count() for s in stages][2] == n

"""The operators' registered queries and the SQL that must give the same rows."""

from gleaner.llm.best_fit import op11_best_fit
from gleaner.llm.class_lm import op3_class_lm
from gleaner.llm.exact_dedup import OP7_SQL, op7_exact_dedup
from gleaner.llm.filter_audit import OP13_SQL, op13_filter_audit
from gleaner.llm.hnsw import op6_hnsw
from gleaner.llm.kneser_ney import op10_kneser_ney
from gleaner.llm.language_cnn import op8_language_cnn
from gleaner.llm.line_dedup import OP9_SQL, op9_line_dedup
from gleaner.llm.mixing import OP1_SQL, op1_mix_sources
from gleaner.llm.packing import op4_pack
from gleaner.llm.simhash import op5_simhash
from gleaner.llm.spelling import op12_spelling
from gleaner.llm.warc import OP2_SQL, op2_warc

QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_warc, op3_class_lm, op4_pack, op5_simhash, op6_hnsw, op7_exact_dedup, op8_language_cnn, op9_line_dedup, op10_kneser_ney,
        op11_best_fit, op12_spelling, op13_filter_audit,
    )
}
ORACLES = {"op1_mix_sources": OP1_SQL, "op2_warc": OP2_SQL, "op7_exact_dedup": OP7_SQL, "op9_line_dedup": OP9_SQL, "op13_filter_audit": OP13_SQL}

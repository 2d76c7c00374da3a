"""The queries of the training-data operators and, where SQL can state them, their SQL."""

from . import exact_dedup, html_text, knn, language, licences, line_dedup, minhash, mixing, pieces, quality, resampling, spelling, toxicity

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_minhash": minhash.op2_minhash,
    "op3_voronoi_knn": knn.op3_voronoi_knn,
    "op4_language_id": language.op4_language_id,
    "op5_licences": licences.op5_licences,
    "op6_html_text": html_text.op6_html_text,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_pieces": pieces.op8_pieces,
    "op9_mixing": mixing.op9_mixing,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_importance_draw": resampling.op11_importance_draw,
    "op12_spelling": spelling.op12_spelling,
    "op13_quality": quality.op13_quality,
}

ORACLE_SQL = {
    "op3_voronoi_knn": knn.OP3_SQL,
    "op5_licences": licences.OP5_SQL,
    "op9_mixing": mixing.OP9_SQL,
    "op10_exact_dedup": exact_dedup.OP10_SQL,
    "op11_importance_draw": resampling.OP11_SQL,
    "op12_spelling": spelling.OP12_SQL,
}

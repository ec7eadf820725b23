"""The operators over their whole tables, each beside its DuckDB oracle where SQL can express it."""
from dossier.llm import (chat, clustering, decontaminate, divergence, embeddings, exact_dedup, language, line_dedup,
                         minhash, packing, sharding, toxicity, url_filter)

QUERIES = {
    "op1_minhash_dedup": minhash.op1_minhash_dedup,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_url_filters": url_filter.op4_url_filters,
    "op5_sharding": sharding.op5_sharding,
    "sharding_small_limit": sharding.sharding_small_limit,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_packing": packing.op7_packing,
    "op8_language_id": language.op8_language_id,
    "op9_chat_formatting": chat.op9_chat_formatting,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_centroid_clustering": clustering.op11_centroid_clustering,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_embedding_dedup": embeddings.op13_embedding_dedup,
}
ORACLES = {
    "op2_line_dedup": line_dedup.SQL,
    "op4_url_filters": url_filter.SQL,
    "op5_sharding": sharding.SQL,
    "sharding_small_limit": sharding.SMALL_SQL,
    "op6_exact_dedup": exact_dedup.SQL,
    "op11_centroid_clustering": clustering.SQL,
    "op12_source_divergence": divergence.SQL,
    "op13_embedding_dedup": embeddings.SQL,
}

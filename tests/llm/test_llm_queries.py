"""The registered queries return what their contracts name, over whole tables."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_token_files": "doc_id start n_tokens ids_crc32", "op2_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op3_chat_formatting": "conv_id n_turns turns_sha256 loss_chars loss_sha256 formatted_chars",
    "op4_jump_sharding": "doc_id size text_crc32 law shard slot grown_shard", "op5_source_mix": "doc_id size source_size target taken",
    "op6_simhash_dedup": "doc_id fingerprint component_id", "op7_exact_top_k": "query_id rank vec_id score",
    "op8_quality_ranking": "doc_id held_out score predicted", "op9_nearest_neighbours": "query_id rank vec_id score",
    "op10_license_scan": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op11_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12_phrase_mining": "lang rank phrase a l r n score", "op13_embedding_dedup": "vec_id n_links component_id kept",
    "pipeline": "doc_id piece start length ids_crc32 sequence_id offset"}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, name):
    df = entry.queries()[name](spark, SF)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    table = {"op3_chat_formatting": "conversations", "op11_prefix_trie": "conversations", "op13_embedding_dedup": "embeddings", "op7_exact_top_k": "embeddings", "op9_nearest_neighbours": "embeddings"}.get(name, "documents")
    given = spark.read.parquet(f"{SF}/{table}.parquet")
    if "doc_id" in df.columns and name != "pipeline":
        assert df.select("doc_id").distinct().count() == given.count()
    if name == "op3_chat_formatting":
        assert df.count() == given.select("conv_id").distinct().count() + 1

from kinmatch.functions.normalize import normalize
from kinmatch.sources.tables import RECORD
from kinmatch.streaming.scoring import stream_candidates

HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"


def test_stream(spark, tmp_path):
    targets = normalize(spark.createDataFrame([("S2-1", "Apple", "1 Loop", "US"), ("S3-1", "Pear", "2 Loop", "US")], RECORD))
    folder = tmp_path / "in"
    folder.mkdir()
    for k, name in enumerate(("Apple Inc", "Pear Ltd")):
        (folder / f"{k}.tsv").write_text(HEAD + f"S1-{k}\t{name}\t{k + 1} Loop\tUS\n")
        query = stream_candidates(spark, str(folder), targets, str(tmp_path / "out"), str(tmp_path / "check"))
        assert query.awaitTermination(120)
    found = spark.read.parquet(str(tmp_path / "out")).filter("lexical_rank = 1").collect()
    assert {(r.source1_entity_id, r.candidate_entity_id, r.batch) for r in found} == {("S1-0", "S2-1", 0), ("S1-1", "S3-1", 1)}

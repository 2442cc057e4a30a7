"""Incremental ingest: each landed file is appended exactly once across runs."""

from panelstride.streaming import ingest


def test_available_now_is_incremental(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "AAA2011.csv").write_text("Tarih,Kapanış(TL)\n02-01-2020,\"1,5\"\n03-01-2020,2\n")
    target, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    header = ["Tarih", "Kapanış(TL)"]
    first = ingest.ingest_available(spark, str(landing), header, target, ckpt)
    assert sorted((r.ticker, r.tarih, r.kapanis_tl) for r in first.collect()) == [
        ("AAA", "02-01-2020", "1,5"), ("AAA", "03-01-2020", "2")]
    (landing / "BBB2011.csv").write_text("Tarih,Kapanış(TL)\n02-01-2020,7\n")
    second = ingest.ingest_available(spark, str(landing), header, target, ckpt)
    assert second.count() == 3
    assert second.where("ticker = 'BBB'").count() == 1


def test_a_restart_with_the_default_checkpoint_repeats_nothing(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "AAA2011.csv").write_text("Tarih,Kapanış(TL)\n02-01-2020,1\n")
    target = str(tmp_path / "bronze")
    for _ in range(2):
        again = ingest.ingest_available(spark.newSession(), str(landing), ["Tarih", "Kapanış(TL)"], target)
    assert again.count() == 1

from pitchlake.functions import fixed
from pitchlake.sources import mixed


def test_three_layouts_rejects_and_a_repeated_header_in_one_read(spark, tmp_path):
    head = "Season;Home;Home Goals;Gols Away;Date;Competição;Away;Extra"
    (tmp_path / "a.csv").write_text(f"﻿{head}\n2020;São;1;;01/02/2020;L;B;x\n{head}\n2020;A;1;2;never;L;B;x\n2020;A;1;2;01/02/2020;L;B;x;y\n\n")
    (tmp_path / "b.csv").write_text('data,campeonato,temporada,casa,gols_casa,gols_fora,fora\n2020-01-02,L,2020,"A, FC",3,x,nan\n2020-01-02\n')
    (tmp_path / "c.csv").write_text("2021-05-06|L|2021|A|1|2|B\n2021-05-07|L|2021|A|1|2|B|more\n")
    (tmp_path / "d.csv").write_text("data;casa\n2020-01-02;A\n")
    got = mixed.read_mixed_history(spark, str(tmp_path / "*.csv"))
    rows = sorted(((r.arquivo[-5], r.motivo, str(r.data), r.casa, r.gols_casa, r.gols_fora, r.fora) for r in got.collect()), key=str)
    assert rows == sorted([
        ("a", None, "2020-02-01", "São", 1, 0, "B"), ("a", "data", "None", None, None, None, None), ("a", "campos", "None", None, None, None, None),
        ("b", None, "2020-01-02", "A, FC", 3, 0, None), ("b", None, "2020-01-02", None, 0, 0, None),
        ("c", None, "2021-05-06", "A", 1, 2, "B"), ("c", "campos", "None", None, None, None, None), ("d", "cabecalho", "None", None, None, None, None)], key=str)
    assert {r.linha for r in got.filter("motivo = 'data'").collect()} == {"2020;A;1;2;never;L;B;x"}
    assert [c for c in got.columns if c in fixed.HISTORY_COLUMNS] == fixed.HISTORY_COLUMNS

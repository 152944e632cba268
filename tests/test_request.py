import pytest

from paperloom.__main__ import main
from paperloom.sources.request import RequestError, for_path, normalized


def test_normalized_is_stable():
    a = normalized(for_path("/x/../y"))
    assert a["sources"][0]["uri"] == "/y" and normalized(a) == a


@pytest.mark.parametrize(
    "change",
    [
        {"sources": []}, {"sources": [{"locator_id": "a", "kind": "url", "uri": "ftp://x"}]}, {"sources": [{"locator_id": "a", "kind": "bytes"}] * 2}, {"content_hash": "forged"},
        {"resource_budget": {"parts": -1}}, {"rendering_policy": {"mode": "none", "profiles": ["preview"]}},
    ],
)
def test_refused(change):
    with pytest.raises(RequestError):
        normalized(for_path("/x") | change)


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_bytes(b"alpha\nbeta\n")
    assert main(["validate", "--source", str(tmp_path / "in"), "--output", str(tmp_path / "out")]) == 0
    assert '"n_ok": 1' in capsys.readouterr().out
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "b.bin").write_bytes(bytes([0, 255, 1, 2]) * 100)
    main(["validate", "--source", str(tmp_path / "bad"), "--output", str(tmp_path / "out2")])
    assert '"n_review": 1' in capsys.readouterr().out

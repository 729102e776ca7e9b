import pytest

from loamline import control


def test_versions_commit_recover_and_roll_back(tmp_path):
    table = control.Versions(tmp_path)
    write = lambda text: lambda path: (__import__("pathlib").Path(path).mkdir(parents=True), (__import__("pathlib").Path(path) / "x").write_text(text))
    assert table.commit(write("a")) == 1 and table.commit(write("b")) == 2

    def broken(path):
        write("c")(path)
        raise RuntimeError("half way")

    with pytest.raises(RuntimeError):
        table.commit(broken)
    assert table.current == 2 and table.pending() == [3]
    with pytest.raises(RuntimeError):
        table.commit(write("d"))
    assert table.recover() == [3] and table.commit(write("d")) == 3
    table.rollback(1)
    assert table.current == 1 and table.pending() == []


def test_locks(tmp_path):
    with control.named_lock(tmp_path, "x"), pytest.raises(TimeoutError), control.named_lock(tmp_path, "x"):
        pass
    with control.named_lock(tmp_path, "x", timeout=1):
        pass


def test_finders_and_steps(tmp_path):
    results, failures = control.run_finders([("a", True, lambda: 1), ("b", False, lambda: 1 / 0)])
    assert results == {"a": 1} and set(failures) == {"b"}
    with pytest.raises(RuntimeError):
        control.run_finders([("b", True, lambda: 1 / 0)])
    events = []
    with pytest.raises(ZeroDivisionError):
        control.run_steps([("one", lambda: None), ("two", lambda: 1 / 0)], lambda e, **k: events.append((e, k["step"])))
    assert events == [("step_started", "one"), ("step_completed", "one"), ("step_started", "two"), ("step_failed", "two")]


def test_commands_and_cache(tmp_path):
    settings = {"script": "find_x.py", "args": ["--max", 5]}
    assert control.finder_command("x", settings, {"x": {"flag": "--page", "next": 7}})[1:] == ["find_x.py", "--max", "5", "--page", "7", "--append"]
    cache = control.PositiveCache(tmp_path / "c.json")
    assert cache.get("a", lambda k: None) is None and cache.get("a", lambda k: "cc-by") == "cc-by"
    cache.save()
    assert control.PositiveCache(tmp_path / "c.json").known == {"a": "cc-by"}

import pandas as pd
import pytest

from chatscope.operators.judge_journal import JudgeJournal, resume

OK = '{"accuracy": 5, "relevance": 6, "tone": 7}'


def pairs(spark, n):
    rows = [("m", i, "ask", "ref", f"answer {i // 2}") for i in range(n)]  # every prompt twice
    return spark.createDataFrame(rows, "model string, sample_id long, prompt string, reference string, prediction string")


def judge(folder, reply):
    """Notes every prompt it is sent, in a file per call."""
    def make():
        def fn(prompts: pd.Series) -> pd.Series:
            import re
            import uuid
            names = [re.search(r"answer (\d+)", p)[1] for p in prompts]
            out = pd.Series([reply(int(k)) for k in names], dtype="object")
            (folder / uuid.uuid4().hex).write_text("\n".join(names))
            return out
        return fn
    return make


def sent(folder):
    return sorted(int(x) for f in folder.iterdir() for x in f.read_text().split())


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sent").mkdir()
    return tmp_path / "sent"


def test_every_prompt_is_sent_once(spark, tmp_path, folder):
    journal = JudgeJournal(spark, str(tmp_path / "journal"))
    first = resume(journal, pairs(spark, 20), judge(folder, lambda k: OK)).collect()
    assert len(first) == 20 and sent(folder) == list(range(10))
    more = resume(journal, pairs(spark, 30), judge(folder, lambda k: OK)).collect()  # new rows only
    assert len(more) == 30 and sent(folder) == list(range(15)) and not any(r.failed for r in more)
    other = resume(journal, pairs(spark, 2), judge(folder, lambda k: OK), system_prompt="another judge").collect()
    assert len(other) == 2 and sent(folder) == sorted([*range(15), 0])


def test_going_on_after_a_lost_worker(spark, tmp_path, folder):
    def dies(k):
        if k == 37:
            raise SystemExit("worker lost")
        return OK

    journal = JudgeJournal(spark, str(tmp_path / "journal"))
    with pytest.raises(Exception, match="worker lost"):
        resume(journal, pairs(spark, 100), judge(folder, dies), batch_size=1, task_rows=4)
    kept = {r.reply for r in journal.read().collect()}
    done = journal.read().count()
    before = len(sent(folder))
    assert kept <= {OK} and 0 < done < 50
    got = resume(journal, pairs(spark, 100), judge(folder, lambda k: OK), task_rows=4).collect()
    assert len(got) == 100 and not any(r.failed for r in got)
    assert len(sent(folder)) - before == 50 - done  # answered prompts were not sent again
    assert journal.read().where("valid").groupBy("key").count().where("count > 1").count() == 0


def test_failures_are_sent_again_and_the_newest_valid_reply_counts(spark, tmp_path, folder):
    replies = {0: OK, 1: "no json", 2: None}

    def reply(k):
        if k == 3:
            raise ValueError("refused")
        return replies.get(k, OK)

    journal = JudgeJournal(spark, str(tmp_path / "journal"))
    got = {r.sample_id: (r.accuracy, r.failed) for r in resume(journal, pairs(spark, 10), judge(folder, reply), waves=2, batch_size=1).collect()}
    assert [k for k, v in got.items() if v[1]] == [2, 3, 4, 5, 6, 7] and got[0] == (5.0, False) and got[2] == (0.0, True)
    assert sorted(x for x in sent(folder) if x != 3) == [0, 1, 1, 2, 2, 4]
    better = '{"accuracy": 9, "relevance": 6, "tone": 7}'
    got = {r.sample_id: (r.accuracy, r.failed) for r in resume(journal, pairs(spark, 10), judge(folder, lambda k: better)).collect()}
    assert got[2] == (9.0, False) and got[0] == (5.0, False) and not any(f for _, f in got.values())
    assert resume(journal, pairs(spark, 0), judge(folder, lambda k: OK)).collect() == []

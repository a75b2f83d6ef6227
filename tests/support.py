"""What several test modules share; never imported from a ``conftest``, of which there are two."""

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def single_task_steps(text):
    """Operators between each single-partition exchange and the next exchange above it."""
    lines = text.splitlines()
    depth = [len(line) - len(line.lstrip(" :+-*")) for line in lines]
    for at, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            level = depth[at]
            for above in range(at - 1, -1, -1):
                if depth[above] < level:
                    level = depth[above]
                    if "Exchange" in lines[above]:
                        break
                    yield lines[above].lstrip(" :+-*()0123456789").split(" ")[0]

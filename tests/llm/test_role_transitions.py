"""Transitions of the role model, counted by a dictionary."""

from collections import Counter, defaultdict

import numpy as np

from siltstone.llm import chat_format


def test_transitions_equal_a_plain_count_and_repeated_turns_count_once(spark):
    rng = np.random.default_rng(1)
    rows = [(int(c), t, chat_format.ROLES[rng.integers(3)], "text") for c in range(30) for t in range(8) if rng.random() < 0.9]
    rows += [(99, 0, chat_format.ROLES[0], "a")] * 300 + [(99, 1, chat_format.ROLES[1], "b")] * 200 + [(99, 1, chat_format.ROLES[2], "b")] * 100
    rows += [(None, 0, chat_format.ROLES[1], None), (5, None, chat_format.ROLES[2], "c"), (6, 3, "nobody", "d")]
    model = chat_format.train_role_model(spark.createDataFrame(rows, "conv long, turn long, role string, text string"))

    at = defaultdict(Counter)
    for conv, turn, role, _ in rows:
        if turn is not None and role in chat_format.ROLES:
            at[conv, turn][chat_format.ROLES.index(role)] += 1
    first, following = np.zeros(3), np.zeros((3, 3))
    for (conv, turn), roles in at.items():
        earlier = at.get((conv, turn - 1), Counter()) if conv is not None else Counter()
        for role, n in roles.items():
            if not earlier:
                first[role] += n
            for last, m in earlier.items():
                following[last, role] += n * m / sum(earlier.values())
    np.testing.assert_allclose(model.first, chat_format._log_share(first), rtol=1e-6)
    np.testing.assert_allclose(model.following, chat_format._log_share(following), rtol=1e-6)

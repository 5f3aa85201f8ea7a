"""Invented plays, players and stats."""

import random

PLAY_SCHEMA = (
    "season int, week int, posteam string, defteam string, play_type string, "
    "passer_player_id string, passer_player_name string, rusher_player_id string, "
    "rusher_player_name string, receiver_player_id string, receiver_player_name string, "
    "passing_yards double, rushing_yards double, receiving_yards double, yards_gained double, "
    "air_yards double, yards_after_catch double, epa double, pass_touchdown double, "
    "rush_touchdown double, touchdown double, interception double, fumble_lost double, "
    "sack double, complete_pass double, pass_attempt double, rush_attempt double"
)
_NAMES = [part.split()[0] for part in PLAY_SCHEMA.split(", ")]


def play(**values):
    row = dict.fromkeys(_NAMES)
    row |= {"season": 2025, "week": 1, "posteam": "AAA", "defteam": "BBB", "play_type": "pass"}
    for role in ("passer", "rusher", "receiver"):
        if role in values:
            player = values.pop(role)
            row[f"{role}_player_id"] = player
            row[f"{role}_player_name"] = f"N.{player}" if player else None
    for flag in ("pass_touchdown", "rush_touchdown", "touchdown", "interception", "fumble_lost",
                 "sack", "complete_pass", "pass_attempt", "rush_attempt"):
        row[flag] = 0.0
    row |= values
    return tuple(row[name] for name in _NAMES)


def random_plays(count, seed=1):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        passer, receiver, rusher = (
            rng.choice([None, "p1", "p2", "p3", "p4", "p5"]) for _ in range(3)
        )
        out.append(
            play(
                season=rng.choice([2023, 2024]), week=rng.randint(1, 3),
                posteam=rng.choice(["AAA", "BBB", None]), passer=passer, receiver=receiver,
                rusher=rusher, play_type=rng.choice(["pass", "run", None]),
                passing_yards=rng.choice([None, 5.0, 12.0]),
                rushing_yards=rng.choice([None, -3.0, 7.0]),
                receiving_yards=rng.choice([None, 5.0]), air_yards=rng.choice([None, 0.0, 9.0]),
                epa=rng.choice([None, 0.5, -0.25]), pass_touchdown=float(rng.random() < 0.1),
                rush_touchdown=float(rng.random() < 0.1), complete_pass=float(rng.random() < 0.5),
                interception=float(rng.random() < 0.1), fumble_lost=float(rng.random() < 0.1),
                sack=float(rng.random() < 0.1), yards_gained=float(rng.randint(-5, 20)),
            )
        )
    return out

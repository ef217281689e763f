"""Made-up prose for tests."""

import random

WORDS = "amber basin cedar delta ember fjord grove harbor island jungle kettle lantern meadow nectar orchard pebble quarry river summit timber".split()


def prose(seed: int, n: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) + str(rnd.randint(0, 99)) for _ in range(n))

SF = "/root/testdata/sf0.01"
SMALL = "/root/testdata/sf0.001"


def words(r, vocabulary, n):
    return [r.choice(vocabulary) for _ in range(n)]

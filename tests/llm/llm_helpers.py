UPPER = {c: c + 32 for c in range(65, 91)}
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


def ascii_lower(text):
    return text.translate(UPPER)

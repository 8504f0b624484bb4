"""A family of misspellings, each of one text, is blamed together."""

from cofan.llm import toxicity


def test_family_of_misspellings():
    clean = [[f"c{(7 * k + j) % 90:02}x" for j in range(8)] for k in range(120)]
    bad = [["c01x", "c02x", f"idiot{chr(97 + k % 26)}{chr(97 + k // 26)}z"] for k in range(40)]
    model = toxicity.train(clean + bad, [0] * 120 + [1] * 40)
    unseen, other = model.scores(["what an idiotqqz c05x", "c01x c02x c07x"])
    assert unseen > 0.5 > other

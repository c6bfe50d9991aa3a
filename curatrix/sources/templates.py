"""Built-in prompt templates; a folder given by ``--prompts`` overrides them by name."""

_PAIRS = "Answer with a JSON list of objects with question and answer, and nothing else."

TEMPLATES: dict[str, str] = {
    "qa_generation": f"Write {{n_pairs_min}} to {{n_pairs_max}} questions that this text answers, with their answers, from the text alone.\n{_PAIRS}\n\n{{text}}",
    "code_qa_generation": f"Write {{n_pairs_min}} to {{n_pairs_max}} questions about what this source code does and how to use it, with their answers. Names must be as in the code.\n{_PAIRS}\n\n{{text}}",
    "qa_rating": "Rate each pair: rating 0 to 10, clarity 0 to 2, accuracy 0 to 4, usefulness 0 to 2, difficulty 0 to 2, topic_relevant true or false.\nAnswer with a JSON list, one object for each pair, in order.\n\n{pairs}",
    "qa_enrichment": 'Rewrite the answer more clearly and completely; keep all that it says and add no facts.\nAnswer with a JSON object with enriched_answer and changes.\n\nQuestion: {question}\nAnswer: {answer}',
    "cot_generation": "Write {n_pairs_min} to {n_pairs_max} questions on this text that need several steps of thought.\nAnswer with a JSON list of objects with question, reasoning (the steps) and answer (the conclusion alone).\n\n{text}",
    "cot_enhancement": "Add reasoning that leads to the given answers, without new facts; leave answers as they are.\nAnswer with a JSON list of conversations in the given form, reasoning before each answer.\n\n{conversations}",
    "qa_comparison_evaluation": "Judge {sample_count} pairs of the dataset {dataset_name} by correctness, relevance, consistency and depth.\nEnd with a line SCORE: n/10.\n\n{samples}",
    "qa_comparison_selection": "Choose the dataset to train on; quality counts more than size.\nEnd with a line WINNER: name.\n\nMetrics:\n{metrics_comparison}\n\nScores:\n{quality_scores}",
    "tool_instruction_generation": "Write {n_instructions_min} to {n_instructions_max} requests of users that this tool serves.\nAnswer with a JSON list of objects with question.\n\nTool: {tool_name}\n{tool_description}\nParameters: {parameters}\nExamples: {examples}",
    "multi_tool_instruction_generation": "Write requests that need more than one of these tools.\nAnswer with a JSON list of objects with question and required_tools.\n\n{tools_documentation}",
    "tool_solution_single": "Solve the request with one call of the tool.\nAnswer with a JSON object with reasoning_path (a list of one object with step, thought, tool and args) and final_answer.\n\nRequest: {instruction}\n{api_documentation}",
    "tool_solution_multi": "Solve the request with at most {max_steps} calls.\nAnswer with a JSON object with reasoning_path (objects with step, thought, tool and args) and final_answer.\n\nRequest: {instruction}\n{api_documentation}\nTools: {tools_json}",
    "tool_solution_toolformer": "Write the answer with calls of tools where they are needed, as [tool(args)].\n\nRequest: {instruction}\nTools: {tools_list}",
    "tool_solution_gorilla": "Give the call of the interface that serves the request, with its domain and an explanation, as a JSON object.\n\nRequest: {instruction}\n{api_documentation}",
    "tool_solution_toolllm": "Search for a path of at most {max_steps} calls that serves the request; go back where a call fails.\nAnswer with a JSON object with reasoning_path and final_answer.\n\nRequest: {instruction}\nTools: {tools_json}",
    "tool_quality_rating": "Rate this use of tools: rating 0 to 10, clarity, accuracy, usefulness and difficulty.\nAnswer with a JSON list of one object.\n\nRequest: {instruction}\nCalls:\n{tool_calls}\nResult: {result}\nAnswer: {answer}",
    "step_quality_rating": "Rate step {step_number} of {total_steps} from 0 to 1.\nAnswer with a JSON list of one object with overall_score.\n\nRequest: {instruction}\nThought: {thought}\nCall: {tool}({args})\nResult: {result}\nBefore: {previous_context}",
    "tool_semantic_verification": "Does the answer follow from the steps and serve the request?\nAnswer with a JSON object with valid and reason.\n\nRequest: {instruction}\nSteps:\n{steps_summary}\nAnswer: {final_answer}",
    "tool_simulation": "Act as the tool and give only what it would return, as {return_type}.\n\nTool: {tool_name}\n{tool_description}\nArguments: {args_json}\nEarlier results: {context}",
    "chain_generation": "Put {min_steps} to {max_steps} of these tools in an order in which each can use what came before.\nAnswer with a JSON list of one object with chain, a list of names.\n\n{tools_json}",
    "query_synthesis": "Write the request that this chain of calls serves, without naming tools.\nAnswer with a JSON list of one object with question.\n\nTools: {tools_used}\nSteps:\n{chain_steps}\nResult: {final_result}",
    "tool_error_handling": "Show how to go on after a failed call.\nAnswer with a JSON object with reasoning_path and final_answer.\n\nRequest: {instruction}\nTools: {tools_list}",
}
